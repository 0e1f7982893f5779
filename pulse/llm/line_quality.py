"""Quality rules: counts of a text, and lines that many documents of a host share.

The counts are expressions over one row. The cross-document rule hashes normalised lines
(lower case, white space folded), counts for each host the distinct texts that hold a
line, and takes lines out that more than ``share`` of the host's distinct texts hold, and
more than ``min_texts``; with ``max_texts``, lines that more than so many texts hold go
whatever the share, so that the limit does not loosen with a host's size. A document is depleted, and rejected, if more than ``depleted``
of its words stood in such lines. Copies of one text count once, so a text is not depleted
by its own copies.

``keep_good`` takes the lines over the limit out of the texts it keeps; ``n_chars`` follows the
text. Verdicts are those of the whole texts, and ``quality_verdicts`` leaves texts alone. The
query has the limit of its SQL, without ``max_texts``; ``keep_good`` has ``MAX_TEXTS``.

Lines are counted in two steps. The first counts documents, with partial sums before the
shuffle, and leaves at most ``average lines / share`` lines per host (with ``max_texts`` the
host's lines over that number). Only places of those
lines are written down, and the exact count of distinct texts and the removal work on them.

Defined cases: null text counts as empty and fails the base rule; null host is a host of
its own; rows that repeat in full get the same verdict each; an empty table gives no rows;
columns beyond ``doc_id``, ``text`` and the host are not looked at.
"""

from pyspark.sql import functions as F

from pulse.llm.columns import SPACES, free_name, held, row_key, text_or_empty, words_of
from pulse.session import shared_folder

MIN_WORDS = 50
REPEAT_PERCENT = 50
SHARE = 0.1
MIN_TEXTS = 20
MAX_TEXTS = 200  # below the share's limit in hosts of more than 2000 texts
DEPLETED = 0.5
# Beyond so many distinct repeated windows, places are found by sorting, not by search.
FEW_WINDOWS = 64
FEW_KEYS = 1_000_000  # rejected rows up to which they are broadcast
FEW_LISTS = 200_000  # rows with lines to remove up to which they are broadcast


def _with_repeat_words(docs):
    """Count the words inside a window that is in ``_repeated``.

    Each array is a column of its own: inside a lambda it would be built anew per element.
    """
    few = F.size("_repeated") <= FEW_WINDOWS
    hit = F.transform("_windows", lambda h: F.array_contains("_repeated", h))
    placed = F.sort_array(
        F.transform("_windows", lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    )
    docs = docs.withColumn("_hit", F.when((F.size("_repeated") > 0) & few, hit))
    docs = docs.withColumn("_placed", F.when(~few, placed))
    by_search = F.size(
        F.filter(
            F.sequence(F.lit(0), F.size("_windows") + 1),
            lambda p: F.coalesce(F.get("_hit", p), F.lit(False))
            | F.coalesce(F.get("_hit", p - 1), F.lit(False))
            | F.coalesce(F.get("_hit", p - 2), F.lit(False)),
        )
    )
    doubled = F.filter(
        "_placed",
        lambda x, k: F.coalesce(F.get("_placed", k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_placed", k + 1)["h"] == x["h"], F.lit(False)),
    )
    covered = F.flatten(F.transform(doubled, lambda x: F.sequence(x["p"], x["p"] + 2)))
    by_sort = F.size(F.array_distinct(covered))
    count = F.when(F.size("_repeated") == 0, 0).when(few, by_search).otherwise(by_sort)
    return docs.withColumn("n_repeat_words", count.cast("long")).drop("_hit", "_placed")


def text_counts(docs):
    """``docs`` (with a column ``_text``) plus the five counts and ``base_failed``."""
    text = F.col("_text")
    lines = F.filter(
        F.split(text, "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0
    )
    docs = docs.withColumn("_words", words_of(text)).withColumn("_lines", lines)
    words = F.col("_words")
    three = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    none = F.array().cast("array<bigint>")
    docs = docs.withColumn("_windows", F.when(F.size(words) >= 3, three).otherwise(none))
    alike = F.size(F.array_distinct("_windows")) < F.size("_windows")
    docs = docs.withColumn("_sorted", F.when(alike, F.sort_array("_windows")).otherwise(none))
    doubles = F.filter("_sorted", lambda h, i: F.coalesce(F.get("_sorted", i - 1) == h, F.lit(False)))
    docs = docs.withColumn("_repeated", F.array_distinct(doubles))
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.col("n_repeat_words"),
    }
    docs = held(_with_repeat_words(docs), counts).drop(
        "_words", "_lines", "_windows", "_sorted", "_repeated"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    return docs.withColumn("base_failed", failed)


def _one_spaced(text):
    return F.translate(F.lower(text), "\t\x0b\x0c\r", "    ")


def _trimmed(line):
    return F.trim(F.regexp_replace(line, " +", " "))


def _folded(line):
    """One line, normalised; the same as in ``_normalised_lines``, as case ends at a line's end."""
    return _trimmed(_one_spaced(line))


def _normalised_lines(text):
    """Hash and number of words of every line with a word, normalised."""
    folded = F.transform(F.split(_one_spaced(text), "\n", -1), _trimmed)
    return F.transform(
        F.filter(folded, lambda line: line != ""),
        lambda line: F.struct(
            F.xxhash64(line).alias("line"),
            (F.length(line) - F.length(F.translate(line, " ", "")) + 1).alias("words"),
        ),
    )


def _places_over_limit(docs, host, share, min_texts, max_texts=None):
    """Lines over the limit of each row: ``key`` (see ``row_key``), ``line``, ``words``, ``times``."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").alias("_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(text_or_empty()).alias("same"),
        text_or_empty().alias("_text"),
    ).withColumn("key", row_key(F.col("_id"), F.col("host"), F.col("_text")))
    limit = F.greatest(F.lit(min_texts), F.col("texts") * share)
    if max_texts is not None:
        limit = F.least(limit, F.lit(max_texts))
    limits = (
        rows.groupBy("host")
        .agg(F.countDistinct("same").alias("texts"))
        .select("host", limit.alias("limit"))
    )
    found = rows.withColumn("_found", _normalised_lines(F.col("_text"))).drop("_text", "_id")
    lines = F.array_distinct(F.transform("_found", lambda x: x["line"]))
    frequent = (
        found.select("host", F.explode(lines).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(limits, "host")
        .where(F.col("rows") > F.col("limit"))
        .select("host", "line", "limit")
    )
    places = (
        found.select("key", "host", "same", F.explode("_found").alias("x"))
        .select("key", "host", "same", F.col("x.line").alias("line"), F.col("x.words").alias("words"))
        .join(frequent, ["host", "line"])
        .groupBy("key", "host", "line", "same", "limit")
        .agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("times"))
    )
    folder = shared_folder(spark, "line-places")
    places.write.parquet(folder)
    places = spark.read.parquet(folder)
    over = (
        places.groupBy("host", "line")
        .agg(F.countDistinct("same").alias("texts"), F.max("limit").alias("limit"))
        .where(F.col("texts") > F.col("limit"))
        .select("host", "line")
    )
    return places.join(over, ["host", "line"]).select("key", "line", "words", "times")


def _words_of_places(places):
    return places.groupBy("key").agg(F.sum(F.col("words") * F.col("times")).alias("removed"))


def removed_words(docs, host="source", share=SHARE, min_texts=MIN_TEXTS):
    """Words of each row that stand in lines over the limit: ``key`` (see ``row_key``), ``removed``.

    Rows without such lines are not listed.
    """
    return _words_of_places(_places_over_limit(docs, host, share, min_texts))


def _without_lines(text, over):
    """``text`` without the lines whose hash is in ``over``."""
    rest = F.filter(
        F.split(text, "\n", -1), lambda line: ~F.array_contains(over, F.xxhash64(_folded(line)))
    )
    return F.array_join(rest, "\n")


def _clean(docs, places, host):
    """``docs`` without the lines in ``places``; other rows stay as they are."""
    folder = shared_folder(docs.sparkSession, "lines-over")
    lines = places.groupBy("key").agg(F.collect_set("line").alias("_over"))
    lines.select("key.a", "key.b", "_over").write.parquet(folder)
    a, b, over, new_text = (free_name(docs, c) for c in ("a", "b", "over", "cleaned"))
    lines = docs.sparkSession.read.parquet(folder).toDF(a, b, over)
    if lines.count() <= FEW_LISTS:  # otherwise both sides are shuffled
        lines = F.broadcast(lines)
    key = _key(host)
    found = docs.join(lines, (key["a"] == F.col(a)) & (key["b"] == F.col(b)), "left")
    cleaned = _without_lines(text_or_empty(), F.col(over))
    found = found.withColumn(new_text, F.when(F.col(over).isNotNull(), cleaned))
    text = F.coalesce(new_text, "text")
    new = {"text": text.cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        chars = F.when(F.col(new_text).isNull(), F.col("n_chars")).otherwise(F.length(new_text))
        new["n_chars"] = chars.cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _key(host):
    return row_key(
        F.col("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")), text_or_empty()
    )


def quality_verdicts(docs, host="source", share=SHARE, min_texts=MIN_TEXTS, depleted=DEPLETED):
    """``doc_id``, ``key``, the counts, ``base_failed`` and ``kept`` of every row."""
    return _verdicts(docs, host, _places_over_limit(docs, host, share, min_texts), depleted)


def _verdicts(docs, host, places, depleted):
    rows = docs.select("doc_id", _key(host).alias("key"), text_or_empty().alias("_text"))
    counted = text_counts(rows).drop("_text")
    removed = _words_of_places(places)
    poor = F.coalesce(F.col("removed"), F.lit(0)) > depleted * F.col("n_words")
    return counted.join(removed, "key", "left").select(
        "doc_id", "key", *COUNTS, "base_failed", (~F.col("base_failed") & ~poor).alias("kept")
    )


def keep_good(
    docs, host="source", share=SHARE, min_texts=MIN_TEXTS, max_texts=MAX_TEXTS, depleted=DEPLETED
):
    """The rows of ``docs`` that pass, with their columns, without lines over the limit.

    Verdicts are written down before they are used: the rejected rows are counted, then joined.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "verdicts")
    places = _places_over_limit(docs, host, share, min_texts, max_texts)
    _verdicts(docs, host, places, depleted).select("key", "kept").write.parquet(folder)
    rejected = spark.read.parquet(folder).where("NOT kept").select("key.a", "key.b").distinct()
    if rejected.count() <= FEW_KEYS:  # otherwise both sides are shuffled
        rejected = F.broadcast(rejected)
    a, b = free_name(docs, "a"), free_name(docs, "b")
    rejected = rejected.toDF(a, b)
    key = _key(host)
    kept = docs.join(rejected, (key["a"] == F.col(a)) & (key["b"] == F.col(b)), "left_anti")
    return _clean(kept, places, host)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return quality_verdicts(docs).drop("key")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM d)),
doubled AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p + k) AS n
  FROM doubled, (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, text, line FROM (
    SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
duplicates AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
folded AS (
  SELECT doc_id, host, text,
         trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS line FROM lines),
over AS (
  SELECT host, line FROM folded JOIN (
    SELECT host, count(DISTINCT text) AS texts FROM d GROUP BY host) USING (host)
  GROUP BY host, line, texts
  HAVING count(DISTINCT text) > greatest(20, 0.1 * texts)),
removed AS (
  SELECT doc_id, sum(len(string_split(line, ' '))) AS n
  FROM folded JOIN over USING (host, line) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(duplicates.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(removed.n, 0) AS removed
  FROM d LEFT JOIN duplicates USING (doc_id) LEFT JOIN repeated USING (doc_id)
  LEFT JOIN removed USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT (removed > 0.5 * n_words) AS kept
FROM counted
"""
