"""From landed feed items to snapshot rows.

A landed row is ``(run_id, source, rank, item)``: the run, the ranked list it came
from, its 0-based place in that list and the story as JSON text.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.functions import scalars as S
from pulse.functions.mentions import extract_mentions, mentions_json
from pulse.functions.terms import DEFAULT_TERMS
from pulse.schemas import ITEM_SCHEMA, RAW_COLUMNS

# Places kept per list, and the lists in order of precedence.
RANK_LIMIT = 100
SOURCES = ["top", "best"]


def ranked_ids(lists, limit=RANK_LIMIT):
    """``(run_id, source, ids)`` with an ordered id array -> one row per kept place."""
    return lists.select(
        "run_id", "source", F.posexplode(F.slice("ids", 1, limit)).alias("rank", "id")
    )


def rank_limit(landed, limit=RANK_LIMIT):
    """The first places of every list, before any other filter."""
    return landed.where(F.col("rank") < limit)


def decode_items(landed):
    """Typed item columns instead of the JSON text; a failed fetch has no fields.

    Unpacking through ``inline`` parses every text once. A filter on fields of a parsed
    column would be pushed below it and parse the text again for each field.
    """
    keep = [c for c in landed.columns if c != "item"]
    return landed.select(*keep, F.inline(F.array(F.from_json("item", ITEM_SCHEMA))))


def valid_stories(items):
    """Stories with a title; jobs, polls, failed and untitled items go."""
    return items.where((F.col("type") == "story") & (F.col("title") != ""))


def to_raw(items, fetched_at=None, terms=DEFAULT_TERMS):
    """Project items on snapshot rows.

    ``fetched_at`` is an aware ``datetime``; without it a row takes the instant its
    run id names. Run, list and rank stay on the row for ``dedup_first``.
    """
    stamp = F.lit(fetched_at.isoformat()) if fetched_at else S.run_instant(F.col("run_id"))
    tagged = items.select(
        "run_id",
        "rank",
        F.coalesce(F.col("id").cast("string"), F.lit("None")).alias("post_id"),
        "source",
        "title",
        S.or_blank(F.col("url")).alias("url"),
        S.or_zero(F.col("score")).cast("int").alias("score"),
        S.or_zero(F.col("descendants")).cast("int").alias("num_comments"),
        S.or_blank(F.col("by")).alias("author"),
        S.or_zero(F.col("time")).cast("bigint").alias("created_utc"),
        stamp.alias("fetched_at"),
        extract_mentions(F.col("title"), terms).alias("mentions"),
    )
    return tagged.select(
        "run_id",
        "rank",
        *RAW_COLUMNS[:-2],
        mentions_json(F.col("mentions")).alias("tool_mentions"),
        F.size("mentions").alias("mention_count"),
    )


def union_sources(*sources):
    """All lists under each other, duplicates kept."""
    first, *rest = sources
    for df in rest:
        first = first.unionByName(df)
    return first


def source_priority(source):
    """Place of a list in the order of precedence; unlisted ones come last."""
    place = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), source)
    return F.when(place > 0, place).otherwise(len(SOURCES) + 1)


def dedup_first(posts):
    """One row per run and post: the earlier list wins, then the better rank.

    The row-number filter is pruned to one row per post on the map side, before the
    exchange, so copies of one post never gather in a task.
    """
    order = Window.partitionBy("run_id", "post_id").orderBy(
        source_priority(F.col("source")), "rank", *_tie_breakers(posts, "run_id", "post_id", "rank")
    )
    return _first(posts, order)


def dedup_latest(posts):
    """One row per post over all runs: its latest snapshot."""
    order = Window.partitionBy("post_id").orderBy(
        F.desc_nulls_last("fetched_at"),
        source_priority(F.col("source")),
        *_tie_breakers(posts, "post_id", "fetched_at"),
    )
    return _first(posts, order)


def _tie_breakers(posts, *used):
    """All columns the order does not have yet, so that it is a total one; the run last."""
    rest = [c for c in posts.columns if c not in used]
    return sorted(rest, key=lambda c: c == "run_id")


def _first(posts, window):
    numbered = posts.withColumn("_place", F.row_number().over(window))
    return numbered.where(F.col("_place") == 1).drop("_place")


def normalize_items(landed, limit=RANK_LIMIT, fetched_at=None, terms=DEFAULT_TERMS):
    """Landed items -> deduplicated snapshot rows with their ``run_id``.

    Titles are tagged after deduplication, so a copy that loses is never tagged.
    """
    items = valid_stories(decode_items(rank_limit(landed, limit)))
    keyed = items.withColumn("post_id", F.col("id").cast("string"))
    kept = dedup_first(keyed).drop("post_id")
    return to_raw(kept, fetched_at, terms).select("run_id", *RAW_COLUMNS)
