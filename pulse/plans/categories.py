"""Category roll-up, share and drill-down."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.plans.common import ROWS, most_first


def category_summary(mentions, measures=ROWS):
    return (
        mentions.groupBy("category")
        .agg(
            measures.rows("total_mentions"),
            F.countDistinct("tool").alias("unique_tools"),
            measures.mean_score("avg_post_score"),
        )
        .orderBy(*most_first("total_mentions", "category"))
    )


def category_share(mentions, measures=ROWS):
    """Part of all mentions per category; the window sees one row per category."""
    totals = mentions.groupBy("category").agg(measures.rows("total_mentions"))
    everything = F.sum("total_mentions").over(Window.partitionBy())
    return totals.select(
        "category", "total_mentions", (F.col("total_mentions") / everything).alias("share")
    )


def category_list(mentions, measures=ROWS):
    return category_summary(mentions, measures).select("category")


def category_drilldown(mentions, category, measures=ROWS):
    return (
        mentions.where(F.col("category") == F.lit(category))
        .groupBy("tool")
        .agg(measures.rows("mentions"), measures.mean_score("avg_score"))
        .orderBy(*most_first("mentions", "tool"))
    )
