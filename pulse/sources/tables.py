"""The two query tables on disk: full refresh, refresh of changed days, open, empty.

A root holds two copies of the tables and a log of loads. A refresh overwrites the copy
that is not in use and then logs it, so readers see both old tables or both new ones,
and a load that fails leaves the tables as they were. Refreshes of one root must not run
at the same time: two would choose the same copy.

``refresh_days`` keeps the tables by the day of the run instead, and writes the days again
whose runs are others than when the day was written: new runs, runs written again, files that
came late, runs that left the window. Each refresh has folders of its own; one small append to
a log of days, which names for each day its folder and its runs, puts all of them in place.
"""

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.operators.transform import build_posts, mentions_from_posts
from pulse.schemas import MENTIONS_SCHEMA, POSTS_SCHEMA
from pulse.sources import bronze as store
from pulse.sources.snapshots import RECENT_DAYS

POSTS = "posts"
MENTIONS = "tool_mentions"
LOADS = "loads"
LOADS_SCHEMA = "load bigint, copy string"
COPIES = ["a", "b"]
DAYS = "days"
# a run as it was when its day was written
RUN_TYPE = "struct<run_id:string,version:bigint,first:timestamp,last:timestamp,loads:array<string>>"
DAYS_SCHEMA = f"load string, day string, compat boolean, runs array<{RUN_TYPE}>"


@dataclass(frozen=True)
class Tables:
    posts: DataFrame
    mentions: DataFrame

    def register(self):
        """Temporary views for SQL users."""
        self.posts.createOrReplaceTempView(POSTS)
        self.mentions.createOrReplaceTempView(MENTIONS)
        return self


def empty_tables(spark):
    return Tables(
        spark.createDataFrame([], POSTS_SCHEMA), spark.createDataFrame([], MENTIONS_SCHEMA)
    )


def _last_load(spark, root):
    try:
        loads = spark.read.schema(LOADS_SCHEMA).parquet(f"{root}/{LOADS}")
        return loads.orderBy(F.desc("load")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_tables(raw, root, compat=True, dedup=None):
    """Replace both tables below a root by what the snapshot rows give.

    The mention rows come from the stored posts, so the raw scan and the cleaning run
    once. Skew in the input does not matter: no step moves rows between tasks.
    """
    spark = raw.sparkSession
    last = _last_load(spark, root)
    number = last["load"] + 1 if last else 0
    copy = COPIES[1] if last and last["copy"] == COPIES[0] else COPIES[0]
    path = f"{root}/{copy}"
    build_posts(raw, compat, dedup).write.mode("overwrite").parquet(f"{path}/{POSTS}")
    posts = spark.read.schema(POSTS_SCHEMA).parquet(f"{path}/{POSTS}")
    mentions_from_posts(posts, compat).write.mode("overwrite").parquet(f"{path}/{MENTIONS}")
    done = spark.createDataFrame([(number, copy)], LOADS_SCHEMA)
    done.coalesce(1).write.mode("append").parquet(f"{root}/{LOADS}")
    return open_tables(spark, root)


def open_tables(spark, root):
    """The tables of the last load, or typed empty ones where nothing was ever loaded.

    Frames stay readable during the next refresh; open the tables again after it.
    """
    last = _last_load(spark, root)
    if last is None:
        return empty_tables(spark)
    if last["copy"] == DAYS:
        return _open_days(spark, root)
    path = f"{root}/{last['copy']}"
    return Tables(
        spark.read.schema(POSTS_SCHEMA).parquet(f"{path}/{POSTS}"),
        spark.read.schema(MENTIONS_SCHEMA).parquet(f"{path}/{MENTIONS}"),
    )


def mentions_path(spark, root):
    """Folder of the last load's mentions."""
    last = _last_load(spark, root)
    if last is None:
        raise ValueError(f"no tables were loaded below {root}")
    if last["copy"] == DAYS:
        raise ValueError(f"the tables below {root} are kept by day, in several folders")
    return f"{root}/{last['copy']}/{MENTIONS}"


def refresh(raw, root, **options):
    """Rebuild from rows if there are any, else open what is there."""
    if raw.isEmpty():
        return open_tables(raw.sparkSession, root)
    return load_tables(raw, root, **options)


# --- by day ------------------------------------------------------------------------------


def _day_log(spark, root):
    """``load, day, compat, runs`` of every day that was written, newest only."""
    try:
        log = spark.read.schema(DAYS_SCHEMA).parquet(f"{root}/{DAYS}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], DAYS_SCHEMA)
    newest = F.max_by(F.struct("load", "compat", "runs"), "load")  # names begin with the time
    return log.groupBy("day").agg(newest.alias("row")).select("day", "row.*")


def _day_of(run_id):
    return F.translate(F.substring(run_id, 1, 10), "/", "-")


def changed_days(spark, root, runs, compat=True):
    """Days whose runs differ from those the tables hold, with the runs they should hold."""
    run = F.struct("run_id", "version", "first", "last", F.sort_array("loads").alias("loads"))
    wanted = runs.groupBy(_day_of(F.col("run_id")).alias("day")).agg(
        F.sort_array(F.collect_list(run)).alias("wanted")
    )
    both = wanted.join(_day_log(spark, root), "day", "full_outer")
    nothing = F.array().cast(f"array<{RUN_TYPE}>")
    wanted, held = F.coalesce("wanted", nothing), F.coalesce("runs", nothing)
    differs = (wanted != held) | ((F.size(wanted) > 0) & (F.col("compat") != F.lit(compat)))
    return both.where(differs).select("day", wanted.alias("runs"))


def refresh_days(spark, bronze, root, days=RECENT_DAYS, now=None, compat=True):
    """The tables over the runs of the last days, writing only days whose runs changed.

    Equal to a full refresh over the same runs. Reads the loads of the changed days and
    writes their rows; other days are not touched. Where there is no run at all, the stored
    tables stay. One refresh of a root at a time; readers see a refresh as a whole.
    """
    runs = store.recent_runs(spark, bronze, days, now)
    if runs.isEmpty():
        return open_tables(spark, root)
    load = f"{time.time_ns() // 1000}-{uuid.uuid4().hex}"
    path, last = f"{root}/{DAYS}", _last_load(spark, root)
    # the days of the window; their runs are few per day
    changed = changed_days(spark, root, runs, compat).collect()
    if changed:
        chosen = [r for day in changed for r in day["runs"]]
        # a day without runs left gets no rows
        chosen = _frame(spark, chosen)
        first = min((r["first"] for d in changed for r in d["runs"]), default=None)
        rows = store.scan_runs(spark, bronze, chosen, first)
        rows = rows.withColumn("day", _day_of(F.col("run_id")))
        posts = build_posts(rows, compat, keep=["day"]).hint("rebalance", "day")
        posts.write.partitionBy("day").parquet(f"{path}/{POSTS}/load={load}")
        stored = spark.read.schema(_with_day(POSTS_SCHEMA)).parquet(f"{path}/{POSTS}/load={load}")
        mentions = mentions_from_posts(stored, compat, keep=["day"]).hint("rebalance", "day")
        mentions.write.partitionBy("day").parquet(f"{path}/{MENTIONS}/load={load}")
        log = spark.createDataFrame(
            [(load, d["day"], compat, d["runs"]) for d in changed], DAYS_SCHEMA
        )
        log.coalesce(1).write.mode("append").parquet(f"{path}/log")
    if last is None or last["copy"] != DAYS:
        number = last["load"] + 1 if last else 0
        done = spark.createDataFrame([(number, DAYS)], LOADS_SCHEMA)
        done.coalesce(1).write.mode("append").parquet(f"{root}/{LOADS}")
    return open_tables(spark, root)


def _with_day(schema):
    return T.StructType([*schema.fields, T.StructField("day", T.StringType())])


def _frame(spark, runs):
    schema = spark.createDataFrame([], f"run {RUN_TYPE}").schema["run"].dataType
    return spark.createDataFrame(runs, schema)


def _open_days(spark, root):
    """Both tables from the folders that the log names for each day."""
    path = f"{root}/{DAYS}"
    by_load = {}
    for row in _day_log(spark, root).where(F.size("runs") > 0).select("load", "day").collect():
        by_load.setdefault(row["load"], []).append(row["day"])  # one row per day

    def rows(table, schema):
        if not by_load:
            return spark.createDataFrame([], schema)
        held = T.StructType([*_with_day(schema).fields, T.StructField("load", T.StringType())])
        found = spark.read.schema(held).option("basePath", f"{path}/{table}").parquet(
            *[f"{path}/{table}/load={load}" for load in by_load]
        )
        current = F.lit(False)
        for load, days in by_load.items():
            current = current | ((F.col("load") == load) & F.col("day").isin(days))
        return found.where(current).select(*schema.names)

    return Tables(rows(POSTS, POSTS_SCHEMA), rows(MENTIONS, MENTIONS_SCHEMA))
