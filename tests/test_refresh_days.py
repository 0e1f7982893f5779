"""Refresh of changed days against a full refresh over the same runs."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest

from pulse import jobs
from pulse.sources import bronze as bronze_store
from pulse.sources import snapshots as lake
from pulse.sources import tables
from pulse.streaming import ingest as stream_ingest
from tests.helpers import raw_row
from tests.test_snapshots import put

NOW = datetime(2024, 3, 10, 12, 0, tzinfo=timezone.utc)


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def some_rows(rng, run):
    return [
        raw_row(
            post_id=f"{run}-{rng.randrange(99)}", score=rng.randrange(50),
            author=rng.choice(["a", "b", "", None]),
            tool_mentions=json.dumps({t: "c" for t in rng.sample(["sql", "spark", "dbt"], rng.randint(0, 3))}),
        )
        for _ in range(rng.randint(0, 4))
    ]


def days_written(root):
    return {p.parent.name + "/" + p.name for p in root.glob("days/posts/load=*/day=*")}


@pytest.mark.parametrize("seed", [1])
def test_any_mix_of_runs_equals_a_full_refresh(spark, tmp_path, seed):
    """New, late and rewritten runs, files added to a run, and runs that leave the window."""
    rng = random.Random(seed)
    root, bronze, state, stored = (str(tmp_path / d) for d in ("lake", "bronze", "state", "tables"))
    runs, now = [], NOW
    for step in range(4):
        now += timedelta(days=rng.choice([0, 1, 2]))
        for _ in range(rng.randint(1, 3)):
            kind = rng.choice(["new", "late", "again", "added"]) if runs else "new"
            day = now - timedelta(days=rng.choice([0, 1]) if kind != "late" else rng.randint(2, 12))
            run = day.strftime("%Y/%m/%d/") + rng.choice(["09-00", "18-00"])
            run = rng.choice(runs) if kind in ("again", "added") else run
            runs.append(run)
            rows = some_rows(rng, run)
            if kind == "added":
                put(f"{root}/{run}", f"more{step}{rng.randrange(99)}", rows, now)
            else:
                version = int(now.timestamp()) + step * 7 + rng.randrange(5)
                put(f"{root}/{run}", f"v{version}-00000", rows, now)
        stream_ingest.ingest_new(spark, root, bronze, state, late_days=None)
        got = tables.refresh_days(spark, bronze, stored, now=now)
        full = tables.load_tables(
            bronze_store.scan_recent_bronze(spark, bronze, now=now), str(tmp_path / f"full{step}")
        )
        again = tables.open_tables(spark, stored)
        for tab in ("posts", "mentions"):
            assert rows_of(getattr(got, tab)) == rows_of(getattr(full, tab)), (step, tab)
            assert rows_of(getattr(again, tab)) == rows_of(getattr(full, tab)), (step, tab)


def test_only_changed_days_are_written(spark, tmp_path):
    root, bronze, state, stored = (str(tmp_path / d) for d in ("lake", "bronze", "state", "tables"))

    def arrive(run, *names):
        put(root, run, [raw_row(post_id=n) for n in names], NOW)
        stream_ingest.ingest_new(spark, root, bronze, state)
        before = days_written(tmp_path / "tables")
        loaded = tables.refresh_days(spark, bronze, stored, now=NOW)
        new = {p.split("day=")[1] for p in days_written(tmp_path / "tables") - before}
        return new, sorted(r["post_id"] for r in loaded.posts.collect())

    assert arrive("2024/03/08/09-00", "a") == ({"2024-03-08"}, ["a"])
    assert arrive("2024/03/09/09-00", "b") == ({"2024-03-09"}, ["a", "b"])
    assert arrive("2024/03/09/18-00", "c") == ({"2024-03-09"}, ["a", "b", "c"])
    before, log = days_written(tmp_path / "tables"), tmp_path / "tables" / "days" / "log"
    files = len(list(log.glob("*.parquet")))
    tables.refresh_days(spark, bronze, stored, now=NOW)
    assert days_written(tmp_path / "tables") == before and len(list(log.glob("*.parquet"))) == files
    # null rendering is part of what a day holds
    assert tables.refresh_days(spark, bronze, stored, now=NOW, compat=False).posts.count() == 3
    assert len(days_written(tmp_path / "tables")) == len(before) + 2
    # nothing recent: the stored tables stay
    assert tables.refresh_days(spark, bronze, stored, now=NOW + timedelta(days=60)).posts.count() == 3
    plan = tables.open_tables(spark, stored).posts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Join" not in plan


def test_a_refresh_cut_off_leaves_the_tables(spark, tmp_path, monkeypatch):
    root, bronze, state, stored = (str(tmp_path / d) for d in ("lake", "bronze", "state", "tables"))
    put(root, "2024/03/08/09-00", [raw_row(post_id="a", tool_mentions='{"sql": "c"}')], NOW)
    stream_ingest.ingest_new(spark, root, bronze, state)
    tables.refresh_days(spark, bronze, stored, now=NOW)
    put(root, "2024/03/08/18-00", [raw_row(post_id="b")], NOW)
    stream_ingest.ingest_new(spark, root, bronze, state)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "mentions_from_posts", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.refresh_days(spark, bronze, stored, now=NOW)
    kept = tables.open_tables(spark, stored)
    assert (kept.posts.count(), kept.mentions.count()) == (1, 1)
    assert tables.refresh_days(spark, bronze, stored, now=NOW).posts.count() == 2


def test_both_kinds_of_refresh_take_turns(spark, tmp_path):
    root, bronze, state, stored = (str(tmp_path / d) for d in ("lake", "bronze", "state", "tables"))
    for n, names in enumerate((("a",), ("a", "b"), ("a", "b", "c"))):
        put(root, f"2024/03/0{n + 5}/09-00", [raw_row(post_id=names[-1])], datetime.now(timezone.utc))
        stream_ingest.ingest_new(spark, root, bronze, state)
        for options in (["--changed"], [], []):
            jobs.main(["refresh", "--bronze", bronze, "--tables", stored, *options])
            posts = tables.open_tables(spark, stored).posts
            assert sorted(r["post_id"] for r in posts.collect()) == list(names)
    with pytest.raises(ValueError):
        jobs.refresh_tables(spark, stored, bronze=bronze, dedup="latest", changed=True)
    tables.refresh_days(spark, bronze, stored)
    with pytest.raises(ValueError):
        tables.mentions_path(spark, stored)
