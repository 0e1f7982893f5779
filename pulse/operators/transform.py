"""Cleaning and enrichment of snapshot rows, and the two tables built from them."""

from pyspark.sql import functions as F

from pulse.functions import scalars as S
from pulse.functions.mentions import mentions_json, parse_mentions
from pulse.operators.ingest import dedup_latest
from pulse.schemas import MENTIONS_COLUMNS, POSTS_COLUMNS

DEFAULT_SOURCE = "top"
NULL_TEXT = "None"


def clean_authors(raw):
    """Drop rows whose author is deleted, removed, blank or missing."""
    return raw.where(S.present_author(F.col("author")))


def transform(raw, dedup=None, keep=()):
    """Cleaned posts with ``mentions`` as a map; narrow, one stage. ``keep`` names more columns.

    A post that was seen in several runs counts once per run. ``dedup="latest"`` keeps
    only its last snapshot, at the price of one exchange; a story whose author is gone by
    then goes as a whole.
    """
    if dedup not in (None, "latest"):
        raise ValueError(f"unknown dedup mode {dedup!r}")
    rows = clean_authors(dedup_latest(raw) if dedup == "latest" else raw)
    score = S.or_zero(F.col("score")).cast("int")
    comments = S.or_zero(F.col("num_comments")).cast("int")
    epoch = F.col("created_utc")
    return rows.select(
        "post_id",
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"),
        S.truncate_title(F.col("title")).alias("title"),
        S.truncate_url(F.col("url")).alias("url"),
        score.alias("score"),
        comments.alias("num_comments"),
        S.engagement_score(score, comments).alias("engagement_score"),
        "author",
        S.created_date(epoch).alias("created_date"),
        S.created_hour(epoch).alias("created_hour"),
        S.created_weekday(epoch).alias("created_weekday"),
        "fetched_at",
        parse_mentions(F.col("tool_mentions")).alias("mentions"),
        *keep,
    )


def _render_nulls(df, compat):
    """The table form of a null: text ``None``, hour 0, blank weekday."""
    if not compat:
        return df
    text = {c: NULL_TEXT for c in ("post_id", "created_date", "fetched_at", "category")}
    filler = {**text, "created_hour": 0, "created_weekday": ""}
    return df.fillna({c: v for c, v in filler.items() if c in df.columns})


def posts_table(cleaned, compat=True, keep=()):
    """The 14 columns of ``posts`` and ``keep``; ``compat=False`` keeps nulls as nulls."""
    table = cleaned.select(
        *POSTS_COLUMNS[:-2],
        mentions_json(F.col("mentions")).alias("tool_mentions"),
        F.size("mentions").alias("mention_count"),
        *keep,
    )
    return _render_nulls(table, compat)


def mentions_table(cleaned, compat=True, keep=()):
    """The 6 columns of ``tool_mentions``: one row per post and term.

    Source, score and fetch time are carried along, so no query needs a join.
    """
    # Exploding the bare map column would make the optimizer add a test that it is not
    # empty and push that test down, which means building every map twice.
    entries = cleaned.select(
        "post_id", "source", "score", "fetched_at", *keep,
        F.explode(F.map_entries("mentions")).alias("mention"),
    )
    table = entries.withColumns(
        {"tool": F.col("mention.key"), "category": F.col("mention.value")}
    ).select(*MENTIONS_COLUMNS, *keep)
    return _render_nulls(table, compat)


def mentions_from_posts(posts, compat=True, keep=()):
    """``tool_mentions`` out of a stored ``posts`` table, reading 5 of its columns."""
    parsed = posts.where(F.col("mention_count") > 0).select(
        "post_id", "source", "score", "fetched_at", *keep,
        parse_mentions(F.col("tool_mentions")).alias("mentions"),
    )
    return mentions_table(parsed, compat, keep)


def build_posts(raw, compat=True, dedup=None, keep=()):
    return posts_table(transform(raw, dedup, keep), compat, keep)


def build_mentions(raw, compat=True, dedup=None):
    return mentions_table(transform(raw, dedup), compat)
