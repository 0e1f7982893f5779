"""Incremental ingest: new snapshot files into Parquet, each exactly once.

A start lists only the open days of a lake: those from the newest ingested run's day, less a
late window, on. Newly listed files and manifests are the stream; each batch reads what they
stand for and adds it as one load. The log of loads says what was read, so a batch that was
cut off and runs again, or a start with a lost checkpoint, adds nothing twice.
"""

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from pulse.sources import bronze as store
from pulse.sources.snapshots import (
    LAKE_FILES, array_files, listed_files, manifest_documents, run_id_of, scan_files, version_of,
)

# Files per micro-batch, so a backlog does not become one huge batch.
FILES_PER_BATCH = 10000
# A file that is this much older than the newest one is skipped: longer than the age of the
# epoch, so that no file is, not even one without a time.
MEMORY = "36500d"
# Days before the newest ingested one that are listed again for files that come late.
LATE_DAYS = 14
LISTED_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def first_open_day(spark, bronze, late_days=LATE_DAYS, now=None):
    """The day from which a start lists the lake; None for all of it.

    Days ahead of the clock do not move the mark: a run with a mistaken date would close
    all others.
    """
    if late_days is None:
        return None
    today = (now or datetime.now(timezone.utc)).strftime("%Y/%m/%d")
    day = F.substring("run_id", 1, 10)
    mark = store.loaded_files(spark, bronze).where(day <= today).agg(F.max(day)).first()[0]
    try:
        return datetime.strptime(mark or "", "%Y/%m/%d").date() - timedelta(days=late_days)
    except ValueError:  # nothing ingested yet, or nothing with a date
        return None


def open_prefixes(spark, root, since):
    """Paths below ``root`` that may hold runs of ``since`` or later.

    Lists the folders on the way only: years, and months and days of the first open ones.
    What is no time folder is always open.
    """
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = []

    def visit(path, bounds):
        for entry in files.listStatus(Path(path)) if files.exists(Path(path)) else []:
            name = entry.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            number = re.fullmatch(r"(?:year=|month=|day=)?(\d{4}|\d{2})", name)
            inner = f"{path}/{name}"
            if not number or not entry.isDirectory() or int(number[1]) > bounds[0]:
                found.append(inner)
            elif int(number[1]) == bounds[0]:
                if len(bounds) > 1:
                    visit(inner, bounds[1:])
                else:
                    found.append(inner)

    visit(root, (since.year, since.month, since.day))
    return found


def arrivals(spark, root, since=None, files_per_batch=FILES_PER_BATCH):
    """Stream of newly listed files, or None where no path is open. No file is opened."""
    if since:
        paths = open_prefixes(spark, root, since)
        if not paths:
            return None
        inside = ",".join(p[len(root) + 1 :] for p in paths)
        root = f"{root}/{{{inside}}}"
    reader = (
        spark.readStream.schema(LISTED_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", MEMORY)
    )
    return listed_files(reader, root, LAKE_FILES).select("path", "modificationTime", "length")


def _add(batch, bronze):
    """Read what a batch of listed files stands for and add it as one load."""
    spark = batch.sparkSession
    known = store.loaded_files(spark, bronze).select(
        "path", F.col("modified_at").alias("modificationTime")
    )
    # at most the files of one batch
    new = batch.join(known, ["path", "modificationTime"], "left_anti").collect()
    if not new:
        return
    listed = spark.createDataFrame(new, "path string, modificationTime timestamp, length bigint")
    files = array_files(listed)
    manifests = [r["path"] for r in new if r["path"].endswith(".manifest")]
    if manifests:
        opened = listed_files(spark.read, manifests, "*.manifest")
        files = files.unionByName(manifest_documents(opened))
    path, modified = F.col("path"), F.col("modificationTime")
    read = listed.select(
        run_id_of(path).alias("run_id"), version_of(path, modified).alias("version"), "path",
        modified.alias("modified_at"),
    )
    store.append_load(scan_files(spark, files), bronze, read)


def ingest_new(spark, root, bronze, checkpoint, files_per_batch=FILES_PER_BATCH,
               late_days=LATE_DAYS):
    """Add every file not ingested before, then stop. Running it again adds nothing.

    A run that was written again is added with its new version; readers take the newest one.
    Files in days before the open ones are found with ``late_days=None``, which lists the
    whole lake.
    """
    root = root.rstrip("/")
    listed = arrivals(spark, root, first_open_day(spark, bronze, late_days), files_per_batch)
    if listed is not None:
        query = (
            listed.writeStream.foreachBatch(lambda batch, number: _add(batch, bronze))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return bronze
