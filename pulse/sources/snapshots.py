"""The snapshot lake: JSON array files below a time path.

A run is one array file ``YYYY/MM/DD/HH-MM.json``, a folder of that name with array files, or
a folder with a manifest. A write of this package into a folder puts its documents aside, below
a hidden folder of its own, and then commits with one small file, ``<version>.manifest``, that
names them. Readers follow the newest manifest, so they see one write or another, never parts
of two, and documents that no manifest names are not there. Nothing is moved or deleted to
commit; ``remove_old_writes`` clears what newer writes replaced.

Foreign arrays cannot be split, so they are read by one task a file. Documents of a manifest
hold one object per line and are read as lines, by as many tasks as their size asks for. For
large volumes Parquet is the form to keep (``pulse.sources.bronze``).
"""

import json
import re
import time
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.schemas import RAW_COLUMNS, RAW_SCHEMA

# Array files of other writers, the text parts of a bulk write, and commits.
LAKE_FILES = "{*.json,part-*.txt,*.manifest}"
RECENT_DAYS = 7

# A document is closed at about this size; a run of the usual size fits in one.
DOCUMENT_BYTES = 32 << 20
_RUN_KEYS = ["year", "month", "day", "time"]
_RUN_PATH = r"(\d{4}/\d{2}/\d{2}/\d{2}-\d{2})(?:\.json$|/)"
_PLAIN_RUN = r"\d{4}/\d{2}/\d{2}/\d{2}-\d{2}\.json$"
_WRITE = r"/_w(\d+)-[0-9a-f]+/[^/]+$"
_MANIFEST = r"/(\d+)\.manifest$"
_MANIFEST_SCHEMA = "count int, files array<struct<name:string,bytes:bigint>>"
FILES_SCHEMA = (
    "run_id string, version bigint, path string, modified_at timestamp, bytes bigint, own boolean"
)


def run_id_of(path):
    """Run id in a lake path, with or without ``key=`` in front of its parts."""
    bare = F.regexp_replace(path, "/(?:year|month|day|time)=", "/")
    return F.regexp_extract(bare, _RUN_PATH, 1)


def version_of(path, modified):
    """Which write of a run a file belongs to; the newest one counts.

    The number in the name of a manifest or of a file that carries one, the modification time
    of a run's own array file, else 0: files in a run's folder belong together.
    """
    numbers = [F.regexp_extract(path, p, 1) for p in (_MANIFEST, _WRITE, r"/v(\d+)-\d+\.json$")]
    named = F.coalesce(*[F.when(n != "", n.cast("bigint")) for n in numbers])
    plain = F.when(path.rlike(_PLAIN_RUN), F.unix_micros(modified))
    return F.coalesce(named, plain, F.lit(0).cast("bigint"))


# --- listing -----------------------------------------------------------------------------


def listed_files(reader, paths, names=LAKE_FILES):
    """``path, modificationTime, length`` and, where it is asked for, ``content``."""
    return (
        reader.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", names)
        .load(paths)
    )


def _found(read):
    """A frame, or None where its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def manifest_documents(manifests):
    """The documents that listed manifests (with ``content``) name; FILES_SCHEMA.

    A manifest that was not written to its end does not count. A run without rows gives one
    row without a path.
    """
    text = F.col("content").cast("string")
    read = manifests.select(
        F.col("path").alias("manifest"), "modificationTime", text.alias("text"),
        F.from_json(text, _MANIFEST_SCHEMA).alias("said"),
    )
    whole = read.where(F.col("text").endswith("]}\n") & (F.size("said.files") == F.col("said.count")))
    files = whole.select("manifest", "modificationTime", F.explode_outer("said.files").alias("file"))
    folder = F.regexp_replace("manifest", r"[^/]+$", "")
    return files.select(
        run_id_of(F.col("manifest")).alias("run_id"),
        version_of(F.col("manifest"), F.col("modificationTime")).alias("version"),
        F.concat(folder, F.col("file.name")).alias("path"),
        F.col("modificationTime").alias("modified_at"),
        F.col("file.bytes").alias("bytes"),
        F.lit(True).alias("own"),
    )


def array_files(listed):
    """Listed array files as they are; FILES_SCHEMA."""
    path, modified = F.col("path"), F.col("modificationTime")
    return listed.where(~path.endswith(".manifest")).select(
        run_id_of(path).alias("run_id"), version_of(path, modified).alias("version"), "path",
        modified.alias("modified_at"), F.col("length").alias("bytes"), F.lit(False).alias("own"),
    )


def current_files(spark, root):
    """The files of every run's newest write. No array file is opened."""
    listed = _found(lambda: listed_files(spark.read, root))
    if listed is None:
        return spark.createDataFrame([], FILES_SCHEMA)
    manifests = listed_files(spark.read, root, "*.manifest")
    files = array_files(listed).unionByName(manifest_documents(manifests))
    newest = files.groupBy("run_id").agg(F.max("version").alias("version"))
    return files.join(newest, ["run_id", "version"], "left_semi")


def lake_runs(spark, root):
    """``run_id, modified_at`` of every run, from a listing: no array is opened.

    A run counts by its file or manifest, even one without rows.
    """
    return current_files(spark, root).groupBy("run_id").agg(
        F.max("modified_at").alias("modified_at")
    )


# --- reading -----------------------------------------------------------------------------


def _arrays(spark, paths):
    """Array files, one task each; one that is not an array of posts fails the job, as
    skipping it would lose rows."""
    rows = (
        spark.read.schema(RAW_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    )
    path, modified = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    return rows.select(
        run_id_of(path).alias("run_id"), *RAW_COLUMNS, modified.alias("modified_at"),
        version_of(path, modified).alias("version"),
    )


def _documents(spark, files):
    """Documents of manifests as lines. ``files``: rows of FILES_SCHEMA.

    A document has the time of its commit. One that is not as long as its manifest says fails
    the job, and so does a damaged line.
    """
    said = spark.createDataFrame(
        [(f["run_id"], f["version"], f["path"].rsplit("/", 1)[1], f["modified_at"], f["bytes"]) for f in files],
        "run_id string, version bigint, name string, modified_at timestamp, bytes bigint",
    )
    path = F.col("_metadata.file_path")
    lines = spark.read.text([f["path"] for f in files]).select(
        "value",
        run_id_of(path).alias("run_id"),
        F.regexp_extract(path, _WRITE, 1).cast("bigint").alias("version"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_size").alias("size"),
    )
    told = lines.join(said, ["run_id", "version", "name"])
    line = F.when(
        F.col("size") != F.col("bytes"),
        F.raise_error(F.concat(F.lit("not as long as its manifest says: "), F.col("run_id"), F.lit(" "), F.col("name"))),
    ).otherwise(F.regexp_replace("value", ",$", ""))
    # a generator holds filters back: pushed below, they would parse lines again, brackets too
    post = F.from_json("line", RAW_SCHEMA, {"mode": "FAILFAST"})
    none = F.array().cast(T.ArrayType(RAW_SCHEMA))
    posts = F.when(F.col("line").isin("[", "]"), none).otherwise(F.array(post))
    return told.withColumn("line", line).select(
        "run_id", "modified_at", "version", F.inline(posts)
    ).select("run_id", *RAW_COLUMNS, "modified_at", "version")


def scan_files(spark, files):
    """Rows of chosen files. Their names go through the driver, as in any file scan."""
    chosen = [f for f in files.collect() if f["path"] is not None]
    own = [f for f in chosen if f["own"]]
    other = [f["path"] for f in chosen if not f["own"]]
    frames = [_documents(spark, own)] if own else []
    if other:
        frames.append(_arrays(spark, other))
    if not frames:
        return empty_snapshots(spark)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def scan_snapshots(spark, root):
    """Every snapshot below a root, local or in an object store; no time bound."""
    return scan_files(spark, current_files(spark, root))


def recent_cutoff(days=RECENT_DAYS, now=None):
    return (now or datetime.now(timezone.utc)) - timedelta(days=days)


def scan_recent_snapshots(spark, root, days=RECENT_DAYS, now=None):
    """Snapshots of the runs whose last file was modified at the cutoff or later.

    Runs are chosen first, from the listing, and then read whole, however long their delivery
    took. Files of other runs are not opened.
    """
    files = current_files(spark, root)
    last = files.groupBy("run_id").agg(F.max("modified_at").alias("last"))
    recent = last.where(F.col("last") >= F.lit(recent_cutoff(days, now))).select("run_id")
    return scan_files(spark, files.join(recent, "run_id", "left_semi"))


def empty_snapshots(spark):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    return empty.select(
        F.lit("").alias("run_id"), *RAW_COLUMNS,
        F.lit(None).cast("timestamp").alias("modified_at"),
        F.lit(None).cast("bigint").alias("version"),
    )


def first_with_rows(*readers):
    """The first reader's rows that are not empty, else the last reader's."""
    df = None
    for reader in readers:
        df = reader()
        if not df.isEmpty():
            break
    return df


def load_snapshots(spark, lake_root=None, local_root="data/raw", days=RECENT_DAYS, now=None):
    """Recent lake snapshots; all local ones where there is no lake or it has no rows."""
    readers = [lambda: scan_snapshots(spark, local_root)]
    if lake_root:
        readers.insert(0, lambda: scan_recent_snapshots(spark, lake_root, days, now))
    return first_with_rows(*readers)


# --- writing -----------------------------------------------------------------------------


def _array_documents(rows, keys, size):
    """``(keys, value)``: array documents of about ``size`` bytes, without a shuffle.

    Every task joins the lines it has, those with equal keys next to each other.
    """
    body = F.to_json(F.struct(*RAW_COLUMNS), {"ignoreNullFields": "false"})
    lines = rows.select(*keys, body.alias("value"))
    if keys:
        lines = lines.sortWithinPartitions(*keys)
    schema = lines.schema

    def join_lines(batches):
        import io
        import struct

        import pyarrow as pa

        # a task holds the bytes of its document once: a list of lines, their join and Arrow's
        # copy would be several times that
        key, held, total = None, None, 0

        def document():
            held.write(b"\n]")
            ends = pa.py_buffer(struct.pack("=ii", 0, held.tell()))
            text = pa.Array.from_buffers(pa.string(), 1, [None, ends, pa.py_buffer(held.getbuffer())])
            arrays = [*[pa.array([k], pa.string()) for k in key], text]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            for *at, line in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (at != key or total + len(line) > size):
                    yield document()
                    held = None
                if held is None:
                    key, held, total = at, io.BytesIO(), 0
                held.write(b",\n" if held.tell() else b"[\n")
                held.write(line.encode())
                total += len(line)
        if held:
            yield document()

    return lines.mapInArrow(join_lines, schema)


def _write_text(documents, path, keys):
    # one document per file
    writer = documents.write.option("maxRecordsPerFile", 1)
    (writer.partitionBy(*keys) if keys else writer).text(path)


class _Folder:
    """A run's place, through the session's file systems."""

    def __init__(self, spark, root, run_id):
        self.Path = spark._jvm.org.apache.hadoop.fs.Path
        self.path, self.plain = f"{root}/{run_id}", f"{root}/{run_id}.json"
        self.files = self.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def status(self, path):
        """``(name, bytes, modified in ms)`` of what lies in a folder."""
        path = self.Path(path)
        found = self.files.listStatus(path) if self.files.exists(path) else []
        return [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found]

    def exists(self, path):
        return self.files.exists(self.Path(path))

    def delete(self, path):
        self.files.delete(self.Path(path), True)

    def versions(self):
        return [int(m[1]) for n, _, _ in self.status(self.path) if (m := re.fullmatch(r"(\d+)\.manifest", n))]

    def plain_version(self):
        if not self.exists(self.plain):
            return -1
        return 1000 * self.files.getFileStatus(self.Path(self.plain)).getModificationTime()

    def next_version(self):
        """Microseconds, and above what is there whatever the clocks say."""
        return max([time.time_ns() // 1000, self.plain_version() + 1000, *(v + 1 for v in self.versions())])

    def commit(self, version, documents):
        """The one small write; it fails if another writer took the version."""
        said = {"count": len(documents), "files": [{"name": n, "bytes": b} for n, b in documents]}
        out = self.files.create(self.Path(f"{self.path}/{version}.manifest"), False)
        try:
            out.write(bytearray((json.dumps(said) + "\n").encode()))
        finally:
            out.close()


def write_snapshot(posts, root, run_id, size=DOCUMENT_BYTES):
    """One run into ``root/YYYY/MM/DD/HH-MM.json``; running it again replaces the run.

    A first write of one document becomes that file, with one move. A run of several
    documents, or one that is written again, is a folder of that name with a manifest. A
    write that fails leaves the run as it was; of two at the same time the one that
    began later counts, as a whole.
    """
    root = root.rstrip("/")
    folder = _Folder(posts.sparkSession, root, run_id)
    version = folder.next_version()
    write = f"_w{version}-{uuid.uuid4().hex}"
    # small pieces of a run come together, large ones stay apart
    _write_text(_array_documents(posts.hint("rebalance"), [], size), f"{folder.path}/{write}", [])
    documents = [
        (f"{write}/{name}", length)
        for name, length, _ in sorted(folder.status(f"{folder.path}/{write}"))
        if name.startswith("part-")
    ]
    alone = not folder.exists(folder.plain) and len(folder.status(folder.path)) == 1
    if len(documents) == 1 and alone:
        document = folder.Path(f"{folder.path}/{documents[0][0]}")
        if folder.files.rename(document, folder.Path(folder.plain)):
            folder.delete(f"{folder.path}/{write}")
            if not folder.status(folder.path):
                folder.delete(folder.path)
            return folder.plain
    folder.commit(version, documents)
    return folder.path


def remove_old_writes(spark, root, run_id, before):
    """Delete what the newest write of a run replaced, and writes that were never committed.

    Only what was last changed before ``before``: leave time for readers of older writes and
    for writers that are at work.
    """
    folder = _Folder(spark, root.rstrip("/"), run_id)
    newest, limit = max(folder.versions(), default=-1), int(before.timestamp() * 1000)
    plain = folder.plain_version()
    if 0 <= plain < min(newest, 1000 * limit):
        folder.delete(folder.plain)
    for name, _, modified in folder.status(folder.path):
        number = re.match(r"_w(\d+)-|(\d+)\.manifest$", name)
        number = int(number[1] or number[2]) if number else 0
        if modified < limit and (number != newest if name.startswith("_w") else number < newest):
            folder.delete(f"{folder.path}/{name}")


def write_snapshots(posts, root, size=DOCUMENT_BYTES):
    """Rows of many runs, told apart by ``run_id``, in one job into a new lake.

    The rebalance brings the rows of a run together, so that it gets few documents, and
    splits a run that holds much of the data. For large volumes Parquet is the form to keep
    (``pulse.sources.bronze``); arrays are for exchange.
    """
    pieces = F.split("run_id", "/")
    keyed = posts.select(
        *[pieces[i].alias(key) for i, key in enumerate(_RUN_KEYS)], *RAW_COLUMNS
    ).hint("rebalance", *_RUN_KEYS)
    _write_text(_array_documents(keyed, _RUN_KEYS, size), root, _RUN_KEYS)
    return root
