"""Leading stories, their table and the spread of their scores."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.functions.mentions import parse_mentions
from pulse.plans.common import most_first, row_count

TOP_STORIES = 50
HISTOGRAM_BINS = 20
TERM_POSTS = 10
ALL_SOURCES = "All"
STORY_COLUMNS = [
    "source", "title", "score", "num_comments", "engagement_score", "mention_count",
    "url", "author", "created_date",
]
TABLE_COLUMNS = ["source", "title", "score", "num_comments", "mention_count", "author"]


def top_stories(posts, source=ALL_SOURCES, limit=TOP_STORIES):
    chosen = posts if source == ALL_SOURCES else posts.where(F.col("source") == F.lit(source))
    return (
        chosen.orderBy(*most_first("engagement_score", "post_id", "fetched_at"))
        .limit(limit)
        .select(*STORY_COLUMNS)
    )


def stories_table(posts, source=ALL_SOURCES, limit=TOP_STORIES):
    return top_stories(posts, source, limit).select(*TABLE_COLUMNS)


def score_histogram(posts, source=ALL_SOURCES, limit=TOP_STORIES, bins=HISTOGRAM_BINS):
    """Equal bins over the scores of the leading stories, at most ``limit`` rows."""
    shown = Window.partitionBy()
    low, high = F.min("score").over(shown), F.max("score").over(shown)
    scores = top_stories(posts, source, limit).select(
        "score", low.alias("low"), ((high - low) / F.lit(bins)).alias("width")
    )
    place = F.floor(F.try_divide(F.col("score") - F.col("low"), F.col("width")))
    binned = scores.withColumn(
        "bin", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    )
    return (
        binned.groupBy("bin", "low", "width")
        .agg(row_count("posts"))
        .select(
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            "posts",
        )
        .orderBy("bin")
    )


def posts_mentioning(posts, term, limit=TERM_POSTS):
    """Posts whose mention map has a term as key.

    A plain term stands in the JSON text as it is, so a text search spares parsing the
    maps that cannot have it.
    """
    tagged = posts.where(F.col("mention_count") > 0)
    if term.isascii() and term.isalnum():
        tagged = tagged.where(F.contains(F.col("tool_mentions"), F.lit(f'"{term}"')))
    return (
        tagged.where(F.map_contains_key(parse_mentions(F.col("tool_mentions")), F.lit(term)))
        .orderBy("post_id", "fetched_at")
        .limit(limit)
        .select("title", "tool_mentions")
    )
