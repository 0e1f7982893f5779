"""Work is spread over tasks and done once per group where it can be."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from checks import events_feed as feed
from pulse.sources import bronze as store
from pulse.sources import rollup
from tests.helpers import raw_frame, raw_row

RUN_ID = "2024/03/01/09-00"
NOW = datetime(2024, 3, 10, 12, 0, tzinfo=timezone.utc)


def many(spark, count, **fields):
    rows = raw_frame(spark, [raw_row(**fields)]).crossJoin(spark.range(count))
    return rows.withColumn("post_id", F.col("id").cast("string")).drop("id").withColumn("run_id", F.lit(RUN_ID))


def stored(rows, path):
    return store.write_bronze(
        rows.withColumns({"modified_at": F.lit(NOW), "version": F.lit(0).cast("bigint")}), path
    )


def test_one_row_group_of_events_is_tagged_by_several_tasks(spark, tmp_path):
    events = spark.range(1_000_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 01:02:03' AS ts", "xxhash64(id) AS user_id",
        "'view' AS event_type", "1.0D AS value", "'{}' AS props",
    )
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    raw = feed.raw_posts(feed.read_events(spark, str(tmp_path)))
    tasks = raw.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) > 1 and sum(t["count"] for t in tasks) == 1_000_000


def test_fetch_times_are_read_after_the_mentions_are_counted(spark, tmp_path):
    rows = many(spark, 100, tool_mentions='{"sql": "q", "spark": "d"}')
    odd = many(spark, 3, tool_mentions='{"sql": "q"}', fetched_at="no time", score=None)
    bronze = stored(rows.unionByName(odd), str(tmp_path / "bronze"))
    loads = [r["load"] for r in store.loaded_files(spark, bronze).collect()]
    sums = rollup.fold(store.rows_of_loads(spark, bronze, loads)).mentions
    got = {(r["tool"], r["fetched_ts"] is None): (r["n"], r["score"], r["scored"]) for r in sums.collect()}
    assert got == {
        ("sql", False): (100, 100, 100), ("spark", False): (100, 100, 100), ("sql", True): (3, 0, 3),
    }
    plan = sums._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2  # by the text, then by the time
