"""What was loaded and when."""

from pyspark.sql import functions as F

from pulse.plans.common import ROWS, SUMS, row_count, side_by_side

RECENT_RUNS = 10


def loaded_counts(posts, mentions):
    return side_by_side(posts.agg(row_count("posts")), mentions.agg(row_count("mentions")))


def status_totals(posts, mentions):
    """Posts, mentions and runs, a run being one distinct fetch time."""
    return side_by_side(
        posts.agg(
            row_count("total_posts"), F.countDistinct("fetched_at").alias("total_runs")
        ),
        mentions.agg(row_count("total_mentions")),
    )


def totals_of_sums(mentions, fetches):
    """The totals from the sums by tool and by fetch time."""
    return side_by_side(
        fetches.agg(SUMS.rows("total_posts"), F.countDistinct("fetched_at").alias("total_runs")),
        mentions.agg(SUMS.rows("total_mentions")),
    )


def run_count(runs):
    """Number of runs, from their listing (``lake_runs``) or from snapshot rows."""
    return runs.agg(F.countDistinct("run_id").alias("runs"))


def recent_runs(posts, limit=RECENT_RUNS, measures=ROWS):
    return (
        posts.groupBy("fetched_at")
        .agg(measures.rows("posts"), F.sum("mention_count").alias("tool_mentions"))
        .orderBy(F.desc_nulls_last("fetched_at"))
        .limit(limit)
    )
