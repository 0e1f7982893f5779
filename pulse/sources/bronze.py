"""The Parquet form of the lake: what everything at scale reads.

    <path>/rows/load=<load>/dt=<day>/...   snapshot rows, by the day their file was modified
    <path>/files/...                       the files of every finished load

A load writes its rows into a folder of its own and is finished by one small append to the
log of files. Readers start from that log: it names each run's newest write, and the loads its
rows lie in. Loads that were not finished are not there, and loads of several writers do
not get in each other's way.
"""

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.schemas import RAW_COLUMNS, RAW_SCHEMA
from pulse.sources.snapshots import RECENT_DAYS, recent_cutoff

BRONZE_COLUMNS = ["run_id", *RAW_COLUMNS, "modified_at", "version"]
ROWS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        *RAW_SCHEMA.fields,
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("version", T.LongType()),
        T.StructField("load", T.StringType()),
        T.StructField("dt", T.DateType()),
    ]
)
LOG_SCHEMA = "load string, run_id string, version bigint, path string, modified_at timestamp"


def with_day(snapshots):
    seconds = F.unix_seconds("modified_at")
    day = F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))
    return snapshots.withColumn("dt", day)


def loaded_files(spark, path):
    """The log: every file of every finished load. Loads of plain rows have no file names."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/files")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def append_load(snapshots, path, files=None):
    """Add snapshot rows as one load.

    ``files`` (``run_id, version, path, modified_at``) are what the rows were read from; they
    also tell of runs without rows. The rebalance splits a large day and merges small ones
    into even files.
    """
    spark = snapshots.sparkSession
    load = f"{time.time_ns() // 1000}-{uuid.uuid4().hex}"
    folder = f"{path}/rows/load={load}"
    rows = with_day(snapshots).select(*BRONZE_COLUMNS, "dt").hint("rebalance", "dt")
    rows.write.partitionBy("dt").parquet(folder)
    if files is None:
        stored = rows_of_loads(spark, path, [load]).select("run_id", "version", "modified_at")
        files = stored.distinct().withColumn("path", F.lit(None).cast("string"))
    log = files.select(F.lit(load).alias("load"), "run_id", "version", "path", "modified_at")
    log.coalesce(1).write.mode("append").parquet(f"{path}/files")
    return load


def write_bronze(snapshots, path):
    """Snapshot rows as one load; see ``append_load``."""
    append_load(snapshots, path)
    return path


def rows_of_loads(spark, path, loads):
    """Rows of some loads; the folders of others are not listed."""
    if not loads:
        return spark.createDataFrame([], ROWS_SCHEMA)
    reader = spark.read.schema(ROWS_SCHEMA).option("basePath", f"{path}/rows")
    return reader.parquet(*[f"{path}/rows/load={load}" for load in loads])


def newest_runs(spark, path, files=None):
    """``run_id, version, first, last, loads``: the newest write of every run in the log.

    ``files`` are the entries of the log to look at, all by default.
    """
    files = loaded_files(spark, path) if files is None else files
    writes = files.groupBy("run_id", "version").agg(
        F.min("modified_at").alias("first"), F.max("modified_at").alias("last"),
        F.collect_set("load").alias("loads"),
    )
    newest = files.groupBy("run_id").agg(F.max("version").alias("version"))
    return writes.join(newest, ["run_id", "version"], "left_semi")


def scan_runs(spark, path, runs, first=None):
    """Rows of some rows of ``newest_runs``; no row was modified before ``first``."""
    loads = runs.select(F.explode("loads").alias("load")).distinct()
    rows = rows_of_loads(spark, path, sorted(r["load"] for r in loads.collect()))  # a few per day
    if first is not None:
        day = F.date_from_unix_date(F.floor(F.unix_seconds(F.lit(first)) / 86400).cast("int"))
        rows = rows.where((F.col("dt") >= day) & (F.col("modified_at") >= F.lit(first)))
    chosen = runs.select("run_id", "version")
    return rows.join(chosen, ["run_id", "version"], "left_semi").select(*BRONZE_COLUMNS, "dt")


def recent_runs(spark, path, days=RECENT_DAYS, now=None):
    """Those of ``newest_runs`` that were last modified at the cutoff or later."""
    return newest_runs(spark, path).where(F.col("last") >= F.lit(recent_cutoff(days, now)))


def scan_bronze(spark, path):
    """All rows of every run's newest write; none where nothing was loaded yet."""
    return scan_runs(spark, path, newest_runs(spark, path))


def scan_recent_bronze(spark, path, days=RECENT_DAYS, now=None):
    """Rows of the runs whose newest write was last modified at the cutoff or later.

    Runs are chosen from the log. The earliest time of the chosen ones then prunes loads,
    day folders and row groups; a run counts as a whole however long its delivery took.
    """
    runs = recent_runs(spark, path, days, now)
    first = runs.agg(F.min("first")).first()[0]
    return scan_runs(spark, path, runs, first)
