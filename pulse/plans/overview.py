"""Overview page: key figures, activity per list, leading posts."""

from pyspark.sql import functions as F

from pulse.functions.scalars import safe_int
from pulse.plans.common import ROWS, SUMS, most_first, row_count, side_by_side

TOP_POSTS = 10
KPI_COUNTS = [
    "total_posts", "sources", "unique_authors", "avg_score", "total_tool_mentions",
]


def overview_kpis(posts):
    """One row of key figures.

    Two distinct counts in one aggregate would copy every input row per count. Folding
    to one row per list and author first leaves the copying to a far smaller set, and
    a prolific author is folded on the map side. The latest time is a text, whose
    maximum would turn that fold into a sort of all rows, so it is taken by itself
    from its own column.
    """
    folded = posts.groupBy("source", "author").agg(
        row_count("n"),
        F.count("score").alias("scored"),
        F.sum("score").alias("score"),
        F.sum("mention_count").alias("mentions"),
    )
    return _key_figures(folded, posts)


def kpis_of_sums(authors, fetches):
    """The key figures from the sums by list and author and by fetch time."""
    folded = authors.withColumnRenamed("mention_count", "mentions")
    return _key_figures(folded, fetches)


def _key_figures(folded, fetches):
    average = F.try_divide(F.sum("score"), F.sum("scored"))
    figures = folded.agg(
        SUMS.rows("total_posts"),
        F.countDistinct("source").alias("sources"),
        F.countDistinct("author").alias("unique_authors"),
        F.round(average, 0).alias("avg_score"),
        F.sum("mentions").alias("total_tool_mentions"),
    )
    return side_by_side(figures, fetches.agg(F.max("fetched_at").alias("last_fetch")))


def kpis_display(posts):
    """The key figures as whole numbers, gaps as 0."""
    shown = [safe_int(F.col(c)).alias(c) for c in KPI_COUNTS]
    return overview_kpis(posts).select(*shown, "last_fetch")


def source_activity(posts, measures=ROWS):
    return (
        posts.groupBy("source")
        .agg(
            measures.rows("post_count"),
            measures.mean_score("avg_score"),
            F.sum("mention_count").alias("tool_mentions"),
        )
        .orderBy(*most_first("post_count", "source"))
    )


def top_posts_with_mentions(posts, limit=TOP_POSTS):
    return (
        posts.where(F.col("mention_count") > 0)
        .orderBy(*most_first("engagement_score", "post_id", "fetched_at"))
        .limit(limit)
        .select(
            "source", "title", "score", "num_comments", "engagement_score",
            "mention_count", "url",
        )
    )
