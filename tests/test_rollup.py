"""Reports from sums per run against the same reports over tables."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from checks import events_feed as feed
from pulse import jobs
from pulse.operators.transform import build_mentions, build_posts
from pulse.plans import activity, categories, overview, status, tools, trend
from pulse.sources import bronze as store
from pulse.sources import rollup
from tests.helpers import raw_frame, raw_row

NOW = datetime(2024, 3, 10, 12, 0, tzinfo=timezone.utc)


def over_tables(rows):
    posts, mentions = build_posts(rows), build_mentions(rows)
    return {
        "overview_kpis": overview.overview_kpis(posts),
        "source_activity": overview.source_activity(posts),
        "top_tools": tools.top_tools(mentions),
        "tool_rankings": tools.tool_rankings(mentions),
        "top20_tools": tools.top20_tools(mentions),
        "tool_source_counts": tools.tool_source_counts(mentions),
        "category_summary": categories.category_summary(mentions),
        "category_share": categories.category_share(mentions),
        "hourly_activity": activity.hourly_activity(posts),
        "weekday_ordered": activity.weekday_ordered(posts),
        "active_authors": activity.active_authors(posts),
        "score_box": activity.score_box(posts),
        "status_totals": status.status_totals(posts, mentions),
        "recent_runs": status.recent_runs(posts),
        "rolling_trend": trend.rolling_trend(trend.with_fetched_time(mentions)),
        "category_drilldown": categories.category_drilldown(mentions, "Databases"),
    }


def check(spark, bronze, sums, **window):
    rows = store.scan_recent_bronze(spark, bronze, **window) if window else store.scan_bronze(spark, bronze)
    want = over_tables(rows)
    got = rollup.reports(rollup.open_rollup(spark, bronze, sums, **window), "Databases")
    assert set(got) == set(want)
    for name, frame in want.items():
        assert dict(got[name].dtypes) == dict(frame.dtypes), name
        assert sorted(map(str, got[name].collect())) == sorted(map(str, frame.collect())), name


def arrive(rows, bronze, version, modified):
    store.write_bronze(
        rows.withColumns({"modified_at": F.lit(modified), "version": F.lit(version).cast("bigint")}), bronze
    )


def test_reports_after_new_late_and_corrected_runs(spark, events, tmp_path):
    raw, bronze, sums = feed.raw_posts(events), str(tmp_path / "bronze"), str(tmp_path / "sums")
    first, last = raw.agg(F.min("run_id"), F.max("run_id")).first()
    half = F.xxhash64("post_id") % 2 == 0
    arrive(raw.where(half & (F.col("run_id") < last)), bronze, 0, NOW - timedelta(days=9))
    rollup.update_rollup(spark, bronze, sums)
    arrive(raw.where(~half & (F.col("run_id") < last)), bronze, 0, NOW - timedelta(days=2))  # late files
    arrive(raw.where((F.col("run_id") == first) & half), bronze, 1, NOW)  # a run written again
    rollup.update_rollup(spark, bronze, sums)
    rollup.update_rollup(spark, bronze, sums)  # nothing new
    check(spark, bronze, sums)
    arrive(raw.where(F.col("run_id") == last), bronze, 0, NOW - timedelta(days=30))
    rollup.update_rollup(spark, bronze, sums)
    check(spark, bronze, sums, days=7, now=NOW)
    assert len(list((tmp_path / "sums" / "authors").iterdir())) == 3
    plan = rollup.reports(rollup.open_rollup(spark, bronze, sums))["top_tools"]
    assert "title" not in plan._jdf.queryExecution().executedPlan().toString()


def test_updates_cut_off_and_loads_not_taken_up(spark, tmp_path, monkeypatch):
    bronze, sums = str(tmp_path / "bronze"), str(tmp_path / "sums")
    rows = raw_frame(spark, [raw_row(post_id="a", tool_mentions='{"sql": "c"}')]).withColumn("run_id", F.lit("2024/03/01/09-00"))
    arrive(rows, bronze, 0, NOW)
    rollup.update_rollup(spark, bronze, sums)
    arrive(rows.unionAll(rows), bronze, 1, NOW)
    opened = rollup.open_rollup(spark, bronze, sums)
    assert rollup.reports(opened)["status_totals"].first().total_posts == 1  # as of the last update
    with monkeypatch.context() as patch:
        patch.setattr(rollup, "LOG_SCHEMA", "no schema")
        with pytest.raises(Exception):
            rollup.update_rollup(spark, bronze, sums)
    rollup.update_rollup(spark, bronze, sums)
    got = rollup.reports(rollup.open_rollup(spark, bronze, sums))["status_totals"].first()
    assert (got.total_posts, got.total_mentions) == (2, 2)
    with pytest.raises(ValueError):
        rollup.update_rollup(spark, bronze, sums, compat=False)


def test_nothing_loaded_yet(spark, tmp_path, capsys):
    bronze, sums = str(tmp_path / "bronze"), str(tmp_path / "sums")
    rollup.update_rollup(spark, bronze, sums)
    for frame in rollup.reports(rollup.open_rollup(spark, bronze, sums), "x").values():
        frame.collect()
    jobs.main(["rollup", "--bronze", bronze, "--sums", sums, "--show", "--category", "x"])
    assert "category_drilldown" in capsys.readouterr().out
