from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from pulse.operators.transform import build_mentions
from pulse.plans import trend
from checks import events_feed as feed
from pulse.sources import bronze as bronze_store
from pulse.sources import snapshots as lake
from pulse.streaming import ingest as stream_ingest
from pulse.streaming import trend as stream_trend
from tests.conftest import SMALL
from tests.helpers import raw_frame, raw_row
from tests.test_snapshots import put


def ids(df):
    return sorted(r["post_id"] for r in df.collect())


def test_every_file_once(spark, tmp_path):
    root, bronze, state = (str(tmp_path / d) for d in ("lake", "bronze", "state"))
    run = lambda: stream_ingest.ingest_new(spark, root, bronze, state, files_per_batch=1)
    put(root, "2024/03/01/09-00", [raw_row(post_id="a"), raw_row(post_id="b")])
    put(root, "2024/03/01/18-00", [raw_row(post_id="c")])
    run()
    assert ids(bronze_store.scan_bronze(spark, bronze)) == ["a", "b", "c"]
    run()
    assert ids(bronze_store.scan_bronze(spark, bronze)) == ["a", "b", "c"]
    put(root, "2024/03/02/09-00", [raw_row(post_id="d")])
    run()
    rows = {(r["run_id"], r["post_id"]) for r in bronze_store.scan_bronze(spark, bronze).collect()}
    assert rows == {
        ("2024/03/01/09-00", "a"), ("2024/03/01/09-00", "b"), ("2024/03/01/18-00", "c"),
        ("2024/03/02/09-00", "d"),
    }


def test_a_file_without_a_time_is_not_skipped(spark, tmp_path):
    root, bronze, state = (str(tmp_path / d) for d in ("lake", "bronze", "state"))
    put(root, "2024/03/01/09-00", [raw_row(post_id="a")])
    stream_ingest.ingest_new(spark, root, bronze, state)
    put(root, "2024/03/01/18-00", [raw_row(post_id="b")], datetime.fromtimestamp(0, timezone.utc))
    stream_ingest.ingest_new(spark, root, bronze, state)
    assert ids(bronze_store.scan_bronze(spark, bronze)) == ["a", "b"]


def test_a_run_written_again_counts_once(spark, tmp_path):
    root, bronze, state = (str(tmp_path / d) for d in ("lake", "bronze", "state"))
    for names, size in ((["z"], 1 << 20), (["d"], 1 << 20), (["a", "b", "c"], 100), (["e"], 100)):
        rows = raw_frame(spark, [raw_row(post_id=n) for n in names])
        lake.write_snapshot(rows, root, "2024/03/01/09-00", size)
        stream_ingest.ingest_new(spark, root, bronze, state)
        assert ids(bronze_store.scan_bronze(spark, bronze)) == names


def test_a_start_lists_the_open_days_only(spark, tmp_path):
    root, bronze, state = (str(tmp_path / d) for d in ("lake", "bronze", "state"))
    for run in ("2023/12/31/09-00", "2024/02/20/09-00", "2024/03/01/09-00", "2024/03/02/18-00"):
        put(root, run, [raw_row(post_id=run)])
    put(root, "year=2024/month=03/day=01/time=18-00", [raw_row(post_id="bulk")])
    put(f"{root}/other", "2020/01/01/09-00", [raw_row(post_id="apart")])
    assert stream_ingest.first_open_day(spark, bronze) is None  # nothing is known yet
    stream_ingest.ingest_new(spark, root, bronze, state)
    assert len(ids(bronze_store.scan_bronze(spark, bronze))) == 6
    since = stream_ingest.first_open_day(spark, bronze, 1)
    assert since == date(2024, 3, 1)
    opened = [p.removeprefix(f"{root}/") for p in stream_ingest.open_prefixes(spark, root, since)]
    assert sorted(opened) == ["2024/03/01", "2024/03/02", "other", "year=2024/month=03/day=01"]
    # a file that comes late is found in an open day, below an unknown folder, and in a later day
    put(root, "2024/03/01/23-00", [raw_row(post_id="late")], datetime.fromtimestamp(0, timezone.utc))
    put(f"{root}/other", "2020/01/02/09-00", [raw_row(post_id="apart too")])
    put(root, "2025/01/01/09-00", [raw_row(post_id="next")])
    put(root, "2024/02/20/18-00", [raw_row(post_id="too late")])
    stream_ingest.ingest_new(spark, root, bronze, state, late_days=1)
    got = set(ids(bronze_store.scan_bronze(spark, bronze)))
    assert {"late", "apart too", "next"} <= got and "too late" not in got
    stream_ingest.ingest_new(spark, root, bronze, state, late_days=None)
    assert len(ids(bronze_store.scan_bronze(spark, bronze))) == 10


def test_days_ahead_of_the_clock_do_not_close_others(spark, tmp_path):
    root, bronze, state = (str(tmp_path / d) for d in ("lake", "bronze", "state"))
    now = datetime(2024, 3, 10, tzinfo=timezone.utc)
    for run in ("2024/03/05/09-00", "2999/01/01/09-00"):
        put(root, run, [raw_row(post_id=run)])
    stream_ingest.ingest_new(spark, root, bronze, state)
    assert stream_ingest.first_open_day(spark, bronze, 2, now) == date(2024, 3, 3)


def test_a_lost_checkpoint_adds_nothing_twice(spark, tmp_path):
    root, bronze = str(tmp_path / "lake"), str(tmp_path / "bronze")
    put(root, "2024/03/01/09-00", [raw_row(post_id="a")])
    lake.write_snapshot(raw_frame(spark, [raw_row(post_id=n) for n in "bcd"]), root, "2024/03/01/18-00", 100)
    for n in range(3):
        stream_ingest.ingest_new(spark, root, bronze, str(tmp_path / f"state{n}"))
        assert ids(bronze_store.scan_bronze(spark, bronze)) == ["a", "b", "c", "d"]
    assert len(list((tmp_path / "bronze" / "rows").glob("load=*"))) == 1


def test_a_batch_cut_off_before_its_end_runs_again(spark, tmp_path, monkeypatch):
    root, bronze, state = (str(tmp_path / d) for d in ("lake", "bronze", "state"))
    put(root, "2024/03/01/09-00", [raw_row(post_id="a")])
    append = bronze_store.append_load

    def cut_off(rows, path, files):
        append(rows, path, files.where("false"))  # rows are written, the log does not name them
        raise RuntimeError("cut off")

    with monkeypatch.context() as patch:
        patch.setattr(bronze_store, "append_load", cut_off)
        with pytest.raises(Exception):
            stream_ingest.ingest_new(spark, root, bronze, state)
    assert bronze_store.scan_bronze(spark, bronze).count() == 0
    stream_ingest.ingest_new(spark, root, bronze, state)
    assert ids(bronze_store.scan_bronze(spark, bronze)) == ["a"]


def test_uncommitted_writes_are_not_ingested(spark, tmp_path, monkeypatch):
    root, bronze, state = (str(tmp_path / d) for d in ("lake", "bronze", "state"))
    rows = raw_frame(spark, [raw_row(post_id=n) for n in "bcd"])
    lake.write_snapshot(rows, root, "2024/03/01/09-00", 100)
    with monkeypatch.context() as patch:
        patch.setattr(lake._Folder, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.write_snapshot(raw_frame(spark, [raw_row(post_id="x")]), root, "2024/03/01/09-00")
    stream_ingest.ingest_new(spark, root, bronze, state)
    assert ids(bronze_store.scan_bronze(spark, bronze)) == ["b", "c", "d"]


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    session = stream_trend.state_session(spark, 2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    mentions = build_mentions(feed.raw_posts(feed.stream_events(session, SMALL)))
    path = stream_trend.run_trend(mentions, str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted(map(tuple, spark.read.parquet(path).collect()))

    timed = trend.with_fetched_time(build_mentions(feed.raw_posts(feed.read_events(spark, SMALL))))
    last = timed.agg(F.max("fetched_ts") - F.expr("INTERVAL 1 DAY")).first()[0]
    closed = trend.rolling_trend(timed).where(F.col("window_end") <= F.lit(last))
    assert got == sorted(map(tuple, closed.collect()))
    assert got


def test_restart_continues(spark, tmp_path):
    """The second start finds its state and adds the windows that closed since."""
    session = stream_trend.state_session(spark, 2)
    root, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    schema = "tool string, category string, fetched_at string"

    def arrive(days):
        rows = [("sql", "c", f"2024-01-{d:02d}T{h}:00:00+00:00") for d in days for h in ("09", "18")]
        session.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(root)
        stream_trend.run_trend(session.readStream.schema(schema).parquet(root), out, state)
        return spark.read.parquet(out)

    first = arrive(range(1, 10)).count()
    both = arrive(range(10, 20))
    assert both.count() > first
    timed = trend.with_fetched_time(spark.read.schema(schema).parquet(root))
    closed = trend.rolling_trend(timed).where("window_end <= TIMESTAMP'2024-01-18 18:00:00'")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, closed.collect()))
