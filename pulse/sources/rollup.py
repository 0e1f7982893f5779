"""Sums that the reports are made of, kept per run beside the Parquet form of the lake.

    mentions   by list, tool, category and half-day of the fetch
    authors    by list and author
    times      by hour and weekday of the story
    fetches    by fetch time
    scores     by list and score, positive ones

An update reads the loads that were finished since the last one, folds their rows to sums per
run and write, and adds these as one part; a small log names the loads of every part, so a
cut-off update leaves nothing behind. Sums of different loads and runs can be added, so
nothing old is read again. Which runs count is decided when the sums are opened: those of each
run's newest write, and if asked for of the last days. A run that was written again thereby takes its
old sums back, whatever trend or report they went into.
"""

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.operators.transform import mentions_table, posts_table, transform
from pulse.plans import activity, categories, overview, status, tools, trend
from pulse.plans.common import SUMS
from pulse.sources import bronze as store
from pulse.sources.snapshots import recent_cutoff

RUN = ["load", "run_id", "version"]
LOG_SCHEMA = "part string, load string, compat boolean"


@dataclass(frozen=True)
class Rollup:
    mentions: DataFrame
    authors: DataFrame
    times: DataFrame
    fetches: DataFrame
    scores: DataFrame


def fold(rows, compat=True):
    """The five tables of sums over snapshot rows with ``load``, per run and write."""
    cleaned = transform(rows, keep=RUN)
    posts = posts_table(cleaned, compat, RUN)
    mentions = mentions_table(cleaned, compat, RUN)
    n = F.count(F.lit(1)).alias("n")
    score = [F.sum("score").alias("score"), F.count("score").alias("scored")]
    found = F.sum("mention_count").alias("mention_count")
    # a run has few fetch times: their texts are read after the counting, not once a mention
    by_text = mentions.groupBy(*RUN, "source", "tool", "category", "fetched_at").agg(n, *score)
    timed = trend.with_fetched_time(by_text, keep_all=True)
    # as the windows of the trend are cut, but rows without a time stay
    seconds = F.unix_seconds("fetched_ts")
    half_day = F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(trend.STEP_SECONDS)))
    return Rollup(
        mentions=timed.groupBy(
            *RUN, "source", "tool", "category", half_day.alias("fetched_ts")
        ).agg(*[F.sum(c).alias(c) for c in ("n", "score", "scored")]),
        authors=posts.groupBy(*RUN, "source", "author").agg(
            n, *score, found, F.sum("num_comments").alias("num_comments")
        ),
        times=posts.groupBy(*RUN, "created_hour", "created_weekday").agg(n, *score),
        fetches=posts.groupBy(*RUN, "fetched_at").agg(n, found),
        scores=activity.positive_scores(posts, RUN).groupBy(*RUN, "source", "score").agg(n),
    )


def _log(spark, path):
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def update_rollup(spark, bronze, path, compat=True):
    """Add the sums of every finished load that is not in yet. One update at a time."""
    log = _log(spark, path)
    if not log.where(F.col("compat") != F.lit(compat)).isEmpty():
        raise ValueError(f"the sums below {path} were made with compat={not compat}")
    finished = store.loaded_files(spark, bronze).select("load").distinct()
    new = sorted(r["load"] for r in finished.join(log, "load", "left_anti").collect())  # a few a day
    if new:
        part = f"{time.time_ns() // 1000}-{uuid.uuid4().hex}"
        sums = fold(store.rows_of_loads(spark, bronze, new), compat)
        for name, table in vars(sums).items():
            table.write.parquet(f"{path}/{name}/{part}")
        done = spark.createDataFrame([(part, load, compat) for load in new], LOG_SCHEMA)
        done.coalesce(1).write.mode("append").parquet(f"{path}/log")
    return path


def open_rollup(spark, bronze, path, days=None, now=None):
    """The sums of each run's newest write; with ``days`` of runs modified in the last days only.

    Loads that no update has taken up yet are left out as a whole.
    """
    log = _log(spark, path)
    parts = sorted(r["part"] for r in log.select("part").distinct().collect())  # one per update
    files = store.loaded_files(spark, bronze).join(log.select("load"), "load", "left_semi")
    runs = store.newest_runs(spark, bronze, files)
    if days is not None:
        runs = runs.where(F.col("last") >= F.lit(recent_cutoff(days, now)))
    runs = runs.select("run_id", "version")
    empty = fold(spark.createDataFrame([], store.ROWS_SCHEMA))

    def table(name):
        nothing = getattr(empty, name)
        if not parts:
            return nothing.drop(*RUN)
        sums = spark.read.schema(nothing.schema).parquet(*[f"{path}/{name}/{p}" for p in parts])
        return sums.join(runs, ["run_id", "version"], "left_semi").drop(*RUN)

    return Rollup(*[table(name) for name in vars(empty)])


def reports(rollup, category=None):
    """The reports that sums can answer, by name; none of them reads a post."""
    mentions, fetches = rollup.mentions, rollup.fetches
    timed = mentions.where(F.col("fetched_ts").isNotNull())
    frames = {
        "overview_kpis": overview.kpis_of_sums(rollup.authors, fetches),
        "source_activity": overview.source_activity(rollup.authors, SUMS),
        "top_tools": tools.top_tools(mentions, measures=SUMS),
        "tool_rankings": tools.tool_rankings(mentions, SUMS),
        "top20_tools": tools.top20_tools(mentions, measures=SUMS),
        "tool_source_counts": tools.tool_source_counts(mentions, SUMS),
        "category_summary": categories.category_summary(mentions, SUMS),
        "category_share": categories.category_share(mentions, SUMS),
        "hourly_activity": activity.hourly_activity(rollup.times, SUMS),
        "weekday_ordered": activity.weekday_ordered(rollup.times, SUMS),
        "active_authors": activity.active_authors(rollup.authors, measures=SUMS),
        "score_box": activity.box_of_sums(rollup.scores),
        "status_totals": status.totals_of_sums(mentions, fetches),
        "recent_runs": status.recent_runs(fetches, measures=SUMS),
        "rolling_trend": trend.rolling_trend(timed, measures=SUMS),
    }
    if category:
        frames["category_drilldown"] = categories.category_drilldown(mentions, category, SUMS)
    return frames
