"""Line dedup: lines that several documents hold stay in the first of them only.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at
least ``min_chars`` code points that ``min_docs`` documents or more hold lose all their lines
but those in the smallest ``doc_id`` that holds them.

Lines are exploded to a 128-bit hash of their key, one row per text and key with the places
of its lines in the text; the texts stay behind. Documents are counted per hash as partial
aggregates, so a line that every document holds sends one row per task. The hashes over the
threshold meet the places again in a join that adaptive execution may split, places to drop
gather per text, and each text is put together from the positions that stay. Texts
move once, in the last join; hashes and places are about a fifth of their size.

Bounds: a task holds one batch of texts (16 MB, or one text). What gathers per text are
places, fewer than its lines. Each step that is read twice is written to the shared folder.

Defined cases: null and empty text are one empty line; rows that share a ``doc_id`` are one
document when documents are counted, and each keeps its own lines; null ``doc_id`` is one
document, after all others; an empty table gives no rows; other columns, whatever their names,
are handed on as they are.
"""

from pyspark.sql import functions as F

from pulse.llm.arrow import bound_batches, map_arrow, record_batch
from pulse.session import shared_folder

MIN_CHARS = 10
MIN_DOCS = 2
SPACES = b" \t\n\x0b\x0c\r"
_LAST = (1 << 63) - 1  # place of a null id in the order


def line_keys(text, min_chars=MIN_CHARS):
    """``key: places`` of the lines of a text (bytes) that may be dropped."""
    found = {}
    for place, line in enumerate(text.split(b"\n")):
        key = line.strip(SPACES).lower()  # bytes lower A-Z only
        if len(key) >= min_chars and (
            len(key) >= 4 * min_chars or key.isascii() or len(key.decode()) >= min_chars
        ):
            found.setdefault(key, []).append(place)
    return found


def _explode(min_chars):
    def run(batches, schema):
        import xxhash

        for batch in batches:
            out = [[], [], [], []]
            for own, same, text in zip(*(c.to_pylist() for c in batch.columns)):
                for key, places in line_keys(text or b"", min_chars).items():
                    for column, value in zip(
                        out, (own, same, xxhash.xxh3_128_digest(key), places)
                    ):
                        column.append(value)
            yield record_batch(schema, out)

    return run


def _keyed(docs):
    """Order of the document and content of the row; rows equal in both lose the same lines."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), F.xxhash64(text), text


def _written(df, purpose):
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def dropped_places(docs, min_chars=MIN_CHARS, min_docs=MIN_DOCS):
    """``own, same, places`` of the rows that lose lines (see ``_keyed``)."""
    own, same, text = _keyed(docs)
    rows = docs.select(own.alias("own"), same.alias("same"), text.cast("binary").alias("text"))
    lines = _written(
        map_arrow(
            rows, _explode(min_chars), "own bigint, same bigint, line binary, places array<int>"
        ),
        "lines",
    )
    if min_docs == 2:  # two documents differ in their smallest and largest
        counted = lines.groupBy("line").agg(F.min("own").alias("first"), F.max("own").alias("last"))
        common = counted.where("first < last")
    else:
        once = lines.select("line", "own").distinct()
        counted = once.groupBy("line").agg(
            F.min("own").alias("first"), F.count(F.lit(1)).alias("docs")
        )
        common = counted.where(F.col("docs") >= min_docs)
    common = _written(common.select("line", "first"), "common-lines")
    later = lines.join(common, "line").where("own > first")
    gathered = later.groupBy("own", "same").agg(F.flatten(F.collect_list("places")).alias("places"))
    return _written(gathered, "dropped-lines")


def _reassembled():
    import pandas as pd

    @F.pandas_udf("n_lines bigint, n_dropped bigint, text string")
    def run(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        rows = []
        for text, gone in zip(texts, places):
            lines = text.split("\n")
            if gone is None:
                rows.append((len(lines), 0, text))
                continue
            gone = set(gone.tolist())
            kept = [line for k, line in enumerate(lines) if k not in gone]
            rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
        return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "text"])

    return run


def dedup_lines(docs, min_chars=MIN_CHARS, min_docs=MIN_DOCS):
    """``row, n_lines, n_dropped, kept_text`` for every row; ``row`` holds its own columns."""
    places = dropped_places(docs, min_chars, min_docs)
    bound_batches(docs.sparkSession)
    own, same, text = _keyed(docs)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), own.alias("own"), same.alias("same"), text.alias("text")
    )
    found = rows.join(places, ["own", "same"], "left")
    done = found.select("row", _reassembled()(F.col("text"), F.col("places")).alias("done"))
    return done.select("row", "done.n_lines", "done.n_dropped", F.col("done.text").alias("kept_text"))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "row.doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM d),
k AS (
  SELECT doc_id, line, place,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, line, place, first IS NOT NULL AND doc_id > first AS gone
  FROM k LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
