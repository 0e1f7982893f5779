"""Document fingerprints: every shingle hash below a fixed fraction of the hash space.

A text's sketch is the sorted set of the hashes of its five-word shingles (lower case) that
lie below ``1 / SCALE`` of the hash space. The limit is the same for all texts, so sketches
grow with the text, the sketch of joined texts is the union of theirs, and the share of one
sketch found in another estimates containment even between very unequal texts. A text with
words and no hash below the limit keeps its smallest one, so short texts can be compared;
a union drops such a hash when it has others below the limit.

``edited_pairs`` gives every row the text after it in descending ``doc_id``. Rows are dealt
by ranges of ``doc_id`` from one small aggregate, each range sorts its rows, and the first
row of each range is also sent to the end of the range before it: one shuffle of the texts,
no task with more than its range.

Defined cases: null text counts as empty; null ``doc_id`` comes last; rows with one
``doc_id`` follow each other by hash of the text, then text; a table of one row is its own
next; an empty table gives no rows; other columns are not looked at. An empty text has an
empty sketch, alike 1 to another empty text and 0 to any other.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.llm.columns import held, shingle_hashes, text_or_empty, words_of

WORDS = 5
SCALE = 8
MAX_RANGES = 2048
_LOWEST = -(1 << 63)


def with_sketch(df, text, name, n=WORDS, scale=SCALE):
    """``df`` plus a sketch column. Steps are columns, so each array is built once."""
    w, h = f"_{name}_words", f"_{name}_hashes"
    df = df.withColumn(w, words_of(F.lower(F.col(text))))
    df = df.withColumn(h, shingle_hashes(F.col(w), n))
    kept = F.filter(F.col(h), lambda x: x < F.lit(_LOWEST + (1 << 64) // scale))
    df = df.withColumn(name, F.array_distinct(kept))
    smallest = F.when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(F.col(name))
    sketch = F.when(F.size(name) > 0, F.sort_array(name)).otherwise(smallest)
    return held(df, {name: sketch}).drop(w, h)


def likeness(a, b):
    """Share of the smaller sketch that lies in the other one."""
    smaller = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(smaller > 0, shared / smaller).otherwise(
        (F.size(a) == F.size(b)).cast("double")
    ).cast("double")


def as_text(hashes):
    """A sketch as text: 16 hex digits per hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _ranges(rows):
    """Number of the range a row lies in, by bounds that deal the rows out evenly."""
    spark = rows.sparkSession
    count = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    at = [i / count for i in range(1, count)]
    bounds = rows.agg(F.percentile_approx("o", at, 100 * count)).first()[0] or []
    bounds = sorted(set(bounds))
    return F.size(F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b < F.col("o")))


def edited_pairs(docs, n=WORDS, scale=SCALE):
    """``doc_id, text, fp, next_text, next_fp`` for every row (see the module)."""
    rows = docs.select(
        "doc_id",
        text_or_empty().alias("text"),
        # descending ids, nulls last
        F.coalesce(F.expr("~CAST(doc_id AS BIGINT)"), F.lit((1 << 63) - 1)).alias("o"),
    )
    place = _ranges(rows)
    rows = rows.withColumn("range", place).withColumn("h", F.xxhash64("text"))
    # one row per range, at most MAX_RANGES
    firsts = (
        rows.groupBy("range").agg(F.min(F.struct("o", "h")).alias("first")).orderBy("range").collect()
    )
    if not firsts:
        return with_sketch(rows, "text", "fp", n, scale).select(
            "doc_id", "text", "fp", F.col("text").alias("next_text"), F.col("fp").alias("next_fp")
        )
    sends = [
        (f["range"], f["first"]["o"], f["first"]["h"], firsts[k - 1]["range"])
        for k, f in enumerate(firsts)
    ]
    spark = docs.sparkSession
    sends = spark.createDataFrame(sends, "range int, o bigint, h bigint, to int")
    copies = (
        rows.join(F.broadcast(sends), ["range", "o", "h"])
        .select("doc_id", "text", "o", F.col("to").alias("range"), "h", F.lit(1).alias("copy"))
    )
    both = rows.withColumn("copy", F.lit(0)).unionByName(copies)
    both = with_sketch(both, "text", "fp", n, scale)
    order = Window.partitionBy("range").orderBy("copy", "o", "h", "text")
    return (
        both.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_fp", F.lead("fp").over(order))
        .where("copy = 0")
        .select("doc_id", "text", "fp", "next_text", "next_fp")
    )


def fingerprints(docs, n=WORDS, scale=SCALE):
    """Sketch and likenesses of every row and its edited text."""
    pairs = edited_pairs(docs, n, scale)
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(
        F.expr("left(text, length(text) - CAST(floor(length(text) / 2) AS INT))"),
        F.expr("left(next_text, CAST(floor(length(text) / 2) AS INT))"),
    )
    pairs = pairs.withColumn("edited", F.when(half > 0, edited).otherwise(F.col("text")))
    pairs = with_sketch(pairs, "edited", "edited_fp", n, scale)
    return pairs.select(
        "doc_id",
        n_chars.cast("long").alias("n_chars"),
        "edited",
        "fp",
        "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return fingerprints(docs).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
