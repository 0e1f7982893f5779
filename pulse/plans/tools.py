"""Tool rankings and the tool by list matrix."""

from pyspark.sql import functions as F

from pulse.operators.ingest import SOURCES
from pulse.plans.common import ROWS, most_first

TOP_TOOLS = 15
CHART_TOOLS = 20


def top_tools(mentions, limit=TOP_TOOLS, measures=ROWS):
    return (
        mentions.groupBy("tool", "category")
        .agg(measures.rows("mentions"), measures.mean_score("avg_post_score"))
        .orderBy(*most_first("mentions", "tool", "category"))
        .limit(limit)
    )


def tool_rankings(mentions, measures=ROWS):
    return (
        mentions.groupBy("tool", "category")
        .agg(
            measures.rows("mentions"),
            F.countDistinct("source").alias("sources"),
            measures.mean_score("avg_post_score"),
        )
        .orderBy(*most_first("mentions", "tool", "category"))
    )


def top20_tools(mentions, limit=CHART_TOOLS, measures=ROWS):
    """Head of the ranking in bar order, smallest first."""
    head = tool_rankings(mentions, measures).limit(limit)
    return head.orderBy(F.asc("mentions"), F.desc("tool"), F.desc("category"))


def tool_source_counts(mentions, measures=ROWS):
    return mentions.groupBy("tool", "source").agg(measures.rows("mentions"))


def tool_source_pivot(mentions, sources=None, measures=ROWS):
    """One row per tool, one column per list, 0 where they never met.

    Without ``sources`` the lists are the usual ones and whatever else occurs; their names
    come from the counts, one row per tool and list.
    """
    counts = tool_source_counts(mentions, measures)
    if sources is None:
        found = counts.where(F.col("source").isNotNull()).select("source").distinct().collect()
        sources = {*SOURCES, *(row["source"] for row in found)}
    return (
        counts.groupBy("tool")
        .pivot("source", sorted(sources))
        .agg(F.sum("mentions"))
        .na.fill(0)
        .orderBy("tool")
    )
