import json
from datetime import datetime, timedelta, timezone

import pytest

from pulse import jobs
from pulse.plans.dashboard import PAGES, categories_page
from pulse.schemas import MENTIONS_SCHEMA
from pulse.sources import snapshots as lake
from pulse.sources import tables
from tests.helpers import raw_frame, raw_row


def landed(path, stories):
    path.mkdir(parents=True)
    with open(path / "items.json", "w") as f:
        for source, rank, item in stories:
            f.write(json.dumps({"source": source, "rank": rank, "item": item}) + "\n")
    return str(path)


def story(i, title):
    return {"id": i, "type": "story", "title": title, "score": i, "by": f"u{i}", "time": 1704067200}


def test_from_landed_items_to_pages(spark, tmp_path, capsys):
    lake_root, tables_root = str(tmp_path / "raw"), str(tmp_path / "tables")
    now = datetime(2024, 1, 31, 9, 0, tzinfo=timezone.utc)
    items = landed(
        tmp_path / "landed",
        [
            ("top", 0, story(1, "Spark and sql")), ("top", 1, None), ("best", 0, story(1, "Spark and sql")),
            ("best", 1, story(2, "torch")), ("best", 100, story(3, "sql")),
        ],
    )
    for _ in range(2):
        jobs.ingest_run(spark, items, lake_root, "2024/01/31/09-00", now)
    rows = lake.scan_snapshots(spark, lake_root).collect()
    assert sorted((r["post_id"], r["source"], r["fetched_at"]) for r in rows) == [
        ("1", "top", "2024-01-31T09:00:00+00:00"), ("2", "best", "2024-01-31T09:00:00+00:00"),
    ]

    loaded = jobs.refresh_tables(spark, tables_root, lake_root)
    assert (loaded.posts.count(), loaded.mentions.count()) == (2, 3)
    # Everything in the lake is too old: the stored tables stay as they are.
    later = datetime.now(timezone.utc) + timedelta(days=30)
    kept = jobs.refresh_tables(spark, tables_root, lake_root, str(tmp_path / "none"), now=later)
    assert kept.posts.count() == 2

    bronze, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    jobs.main(["bronze", "--lake", lake_root, "--bronze", bronze, "--state", state])
    again = jobs.refresh_tables(spark, str(tmp_path / "t2"), bronze=bronze)
    assert sorted(map(str, again.posts.collect())) == sorted(map(str, loaded.posts.collect()))

    jobs.main(["show", "--tables", tables_root, "--page", "tools"])
    assert "spark" in capsys.readouterr().out


def test_damaged_landed_line_fails(spark, tmp_path):
    items = landed(tmp_path / "landed", [("top", 0, story(1, "sql"))])
    with open(f"{items}/items.json", "a") as f:
        f.write('{"source": "top", "rank": 1, "item": \n')
    with pytest.raises(Exception):
        jobs.ingest_run(spark, items, str(tmp_path / "raw"), "2024/01/31/09-00")


def test_first_refresh_finds_nothing(spark, tmp_path):
    loaded = jobs.refresh_tables(spark, str(tmp_path / "t"), bronze=str(tmp_path / "none"))
    assert loaded.posts.count() == 0 and loaded.mentions.columns == MENTIONS_SCHEMA.names


def test_show_options_and_trend(spark, tmp_path, capsys):
    root = str(tmp_path / "tables")
    names = [f"tool{i:02d}" for i in range(70)]
    rows = [
        raw_row(post_id=n, source="best" if i % 2 else "top", tool_mentions=json.dumps({n: "Databases"}))
        for i, n in enumerate(names)
    ]
    tables.load_tables(raw_frame(spark, rows), root)
    jobs.main(["show", "--tables", root, "--page", "tools"])
    assert all(n in capsys.readouterr().out for n in names[:1]) and len(names) > 50
    jobs.main(["show", "--tables", root, "--page", "categories", "--category", "Databases", "--rows", "2"])
    assert "drilldown" in capsys.readouterr().out
    out = str(tmp_path / "out")
    jobs.main(["show", "--tables", root, "--page", "stories", "--source", "best", "--term", "tool01", "--out", out])
    assert {r["source"] for r in spark.read.json(f"{out}/table").collect()} == {"best"}
    assert spark.read.json(f"{out}/mentioning").count() == 1
    jobs.main(["show", "--tables", root, "--page", "tools", "--out", out])
    assert spark.read.json(f"{out}/rankings").count() == 70
    trend, stream = str(tmp_path / "trend"), str(tmp_path / "stream")
    jobs.main(["trend", "--tables", root, "--out", trend])
    assert spark.read.parquet(trend).count() == 70 * 14
    jobs.main(["trend", "--tables", root, "--out", stream, "--state", str(tmp_path / "state")])
    assert spark.read.parquet(stream).columns == spark.read.parquet(trend).columns


def test_every_page_on_nothing_and_on_rows(spark, tmp_path):
    empty = tables.empty_tables(spark)
    for page in PAGES.values():
        for frame in page(empty.posts, empty.mentions).values():
            frame.collect()
    assert "drilldown" in categories_page(empty.posts, empty.mentions, "Databases")
