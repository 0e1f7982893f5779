"""Mentions per tool in a 7-day window that moves by half a day.

Counting per half-day first means a mention is counted once instead of being copied
into each of the 14 windows it lies in; only the half-day counts are spread.
The same plan runs on a batch and on a stream.
"""

from pyspark.sql import functions as F

from pulse.functions.scalars import fetched_timestamp
from pulse.plans.common import ROWS

SPAN = "7 days"
STEP = "12 hours"
STEP_SECONDS = 12 * 3600


def with_fetched_time(mentions, keep_all=False):
    """``mentions`` with ``fetched_ts``; those without a time only if ``keep_all``."""
    timed = mentions.withColumn("fetched_ts", fetched_timestamp(F.col("fetched_at")))
    return timed if keep_all else timed.where(F.col("fetched_ts").isNotNull())


def rolling_trend(timed, span=SPAN, step=STEP, measures=ROWS):
    """``timed`` has ``fetched_ts``, ``tool`` and ``category``; ``span`` is a multiple of ``step``."""
    per_step = timed.groupBy(F.window("fetched_ts", step).alias("step"), "tool", "category")
    counts = per_step.agg(measures.rows("n"))
    inside = F.window(F.window_time("step"), span, step).alias("span")
    windows = counts.groupBy(inside, "tool", "category").agg(F.sum("n").alias("mentions"))
    return windows.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        "tool",
        "category",
        "mentions",
    )
