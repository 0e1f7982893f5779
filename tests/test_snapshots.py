import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pulse.schemas import RAW_COLUMNS
from pulse.session import shared_folder
from checks import events_feed as feed
from pulse.sources import bronze as bronze_store
from pulse.sources import snapshots as lake
from tests.helpers import initial_plan, raw_frame, raw_row

NOW = datetime(2024, 3, 10, 12, 0, tzinfo=timezone.utc)


def put(root, run_id, rows, modified=None, indent=2):
    """A snapshot the way a plain program lands it: one pretty-printed array."""
    path = os.path.join(root, f"{run_id}.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(rows, f, indent=indent)
    if modified:
        os.utime(path, (modified.timestamp(), modified.timestamp()))
    return path


def ids(df):
    return sorted(r["post_id"] for r in df.collect())


def all_rows(df):
    return sorted(map(str, df.select(*RAW_COLUMNS).collect()))


def test_foreign_arrays_are_read_whole(spark, tmp_path):
    root = str(tmp_path)
    put(root, "2024/03/01/09-00", [raw_row(post_id="a"), raw_row(post_id="b")])
    put(root, "2024/03/01/18-00", [raw_row(post_id="c")], indent=None)
    put(root, "2024/03/02/09-00", [])
    df = lake.scan_snapshots(spark, root)
    assert ids(df) == ["a", "b", "c"]
    assert {(r["run_id"], r["post_id"]) for r in df.collect()} == {
        ("2024/03/01/09-00", "a"), ("2024/03/01/09-00", "b"), ("2024/03/01/18-00", "c"),
    }


def test_other_files_are_ignored(spark, tmp_path):
    put(str(tmp_path), "2024/03/01/09-00", [raw_row(post_id="a")])
    (tmp_path / "2024" / "notes.csv").write_text("x")
    (tmp_path / "2024" / "notes.txt").write_text("x")
    assert ids(lake.scan_snapshots(spark, str(tmp_path))) == ["a"]


def test_decoded_mentions_and_missing_fields(spark, tmp_path):
    row = raw_row(post_id="a")
    row["tool_mentions"] = {"sql": "Query Languages"}
    del row["score"], row["source"]
    put(str(tmp_path), "2024/03/01/09-00", [row])
    got = lake.scan_snapshots(spark, str(tmp_path)).first()
    assert json.loads(got["tool_mentions"]) == {"sql": "Query Languages"}
    assert got["score"] is None and got["source"] is None


def test_damaged_file_fails_the_scan(spark, tmp_path):
    put(str(tmp_path), "2024/03/01/09-00", [raw_row()])
    (tmp_path / "2024/03/01/18-00.json").write_text('[{"post_id": "x"')
    with pytest.raises(Exception):
        lake.scan_snapshots(spark, str(tmp_path)).collect()


def test_recent_files_up_to_the_exact_cutoff(spark, tmp_path):
    cutoff = NOW - timedelta(days=7)
    root = str(tmp_path)
    files = {
        "at": cutoff, "before": cutoff - timedelta(milliseconds=1), "after": cutoff + timedelta(milliseconds=1),
        "new": NOW, "old": NOW - timedelta(days=30),
    }
    for day, (name, modified) in enumerate(files.items(), 1):
        put(root, f"2024/03/0{day}/09-00", [raw_row(post_id=name)], modified)
    assert ids(lake.scan_recent_snapshots(spark, root, now=NOW)) == ["after", "at", "new"]
    assert ids(lake.scan_recent_snapshots(spark, root, days=60, now=NOW)) == ["after", "at", "before", "new", "old"]


def test_old_files_are_not_opened(spark, tmp_path):
    """An old file that would fail the scan does not, since it is pruned by its time."""
    root = str(tmp_path)
    put(root, "2024/03/09/09-00", [raw_row(post_id="new")], NOW)
    old = put(root, "2024/01/01/09-00", [], NOW - timedelta(days=30))
    with open(old, "w") as f:
        f.write('[{"post_id": ')
    os.utime(old, ((NOW - timedelta(days=30)).timestamp(),) * 2)
    assert ids(lake.scan_recent_snapshots(spark, root, now=NOW)) == ["new"]


def test_time_bound_is_on_the_file_not_the_run(spark, tmp_path):
    put(str(tmp_path), "2020/01/01/09-00", [raw_row(post_id="late")], NOW)
    assert ids(lake.scan_recent_snapshots(spark, str(tmp_path), now=NOW)) == ["late"]


def test_fallbacks(spark, tmp_path):
    local, store = str(tmp_path / "local"), str(tmp_path / "store")
    put(local, "2020/01/01/09-00", [raw_row(post_id="local")], NOW - timedelta(days=400))
    load = lambda root: ids(lake.load_snapshots(spark, root, local, now=NOW))
    assert load(None) == ["local"]
    assert load(store) == ["local"]
    put(store, "2024/03/01/09-00", [raw_row(post_id="old")], NOW - timedelta(days=8))
    assert load(store) == ["local"]
    put(store, "2024/03/10/09-00", [raw_row(post_id="new")], NOW)
    assert load(store) == ["new"]
    empty = lake.load_snapshots(spark, None, str(tmp_path / "nowhere"))
    assert empty.count() == 0 and empty.columns == bronze_store.BRONZE_COLUMNS


def test_snapshot_round_trip(spark, tmp_path):
    rows = [raw_row(post_id=str(i), title='q"uo\te\n,]', url=None, score=None) for i in range(50)]
    raw = raw_frame(spark, rows)
    path = lake.write_snapshot(raw, str(tmp_path), "2024/03/01/09-00")
    assert path.endswith("/2024/03/01/09-00.json")
    with open(path) as f:
        assert len(json.load(f)) == 50
    back = lake.scan_snapshots(spark, str(tmp_path))
    assert all_rows(back) == all_rows(raw)
    assert {r["run_id"] for r in back.collect()} == {"2024/03/01/09-00"}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_writing_a_run_again_replaces_it(spark, tmp_path, mode):
    root = str(tmp_path)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    many = raw_frame(spark, [raw_row(post_id=str(i)) for i in range(5000)])
    lake.write_snapshot(many, root, "2024/03/01/09-00")
    lake.write_snapshot(raw_frame(spark, [raw_row(post_id="a")] * 3), root, "2024/03/01/09-00")
    lake.write_snapshot(raw_frame(spark, [raw_row(post_id="z")]), root, "2024/03/01/18-00")
    lake.write_snapshot(raw_frame(spark, [raw_row(post_id="b")]), root, "2024/03/01/09-00")
    assert ids(lake.scan_snapshots(spark, root)) == ["b", "z"]
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def array_sizes(root):
    """Rows per array file, by folder."""
    sizes = []
    for folder, _, files in os.walk(root):
        for name in files:
            if name.endswith((".txt", ".json")):
                with open(os.path.join(folder, name)) as f:
                    sizes.append((folder, len(json.load(f))))
    return sizes


def test_large_run_is_split_into_bounded_arrays(spark, tmp_path):
    """5000 rows, a third of them identical, keep their number and stay in valid arrays."""
    row, size = raw_row(), 50_000
    rows = spark.range(0, 5000, 1, 3).select(
        *[
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(c)
            if c == "post_id"
            else F.lit(row[c]).alias(c)
            for c in RAW_COLUMNS
        ]
    )
    run = "2024/03/01/09-00"

    def sizes():
        files = lake.current_files(spark, str(tmp_path)).where("path IS NOT NULL").collect()
        texts = [open(f["path"].removeprefix("file:")).read() for f in files]
        assert [len(t.encode()) for t in texts] == [f["bytes"] for f in files]
        return [len(json.loads(t)) for t in texts], sum(map(len, texts))

    lake.write_snapshot(rows, str(tmp_path), run, size)
    counts, total = sizes()
    assert sum(counts) == 5000 and total / size <= len(counts) <= total / size + 5
    lake.write_snapshot(rows.limit(3), str(tmp_path), run)
    assert sizes()[0] == [3]
    lake.write_snapshot(rows, str(tmp_path), run, size)
    counts = lake.scan_snapshots(spark, str(tmp_path)).groupBy("post_id").count()
    assert counts.where("post_id = 'hot'").first()["count"] == 1667


def test_many_runs_in_one_job(spark, events, tmp_path):
    raw = feed.raw_posts(events)
    root = lake.write_snapshots(raw, str(tmp_path / "lake"))
    back = lake.scan_snapshots(spark, root)
    assert all_rows(back) == all_rows(raw)
    by_run = lambda df: {(r["run_id"], r["count"]) for r in df.groupBy("run_id").count().collect()}
    assert by_run(back) == by_run(raw)


def test_one_run_with_a_third_of_all_rows(spark, tmp_path):
    row = raw_row()
    rows = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "2024/03/01/09-00")
        .otherwise(F.concat(F.lit("2024/02/"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit("/18-00")))
        .alias("run_id"),
        *[F.col("id").cast("string").alias(c) if c == "post_id" else F.lit(row[c]).alias(c) for c in RAW_COLUMNS],
    )
    root = lake.write_snapshots(rows, str(tmp_path / "lake"), 200_000)
    sizes = array_sizes(root)
    assert sum(n for _, n in sizes) == 9000 and max(n for _, n in sizes) <= 1500
    back = lake.scan_snapshots(spark, root)
    assert back.where("run_id = '2024/03/01/09-00'").count() == 3000
    assert all_rows(back) == all_rows(rows)


def test_bronze_prunes_by_day_and_is_exact(spark, tmp_path):
    root, bronze = str(tmp_path / "lake"), str(tmp_path / "bronze")
    cutoff = NOW - timedelta(days=7)
    files = {
        "at": cutoff, "before": cutoff - timedelta(milliseconds=1), "new": NOW, "old": NOW - timedelta(days=30),
    }
    for day, (name, modified) in enumerate(files.items(), 1):
        put(root, f"2024/03/0{day}/09-00", [raw_row(post_id=name)], modified)
    bronze_store.write_bronze(lake.scan_snapshots(spark, root), bronze)
    assert ids(bronze_store.scan_bronze(spark, bronze)) == ["at", "before", "new", "old"]
    recent = bronze_store.scan_recent_bronze(spark, bronze, now=NOW)
    assert ids(recent) == ["at", "new"]
    plan = initial_plan(recent)
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThanOrEqual(modified_at" in plan


def test_a_run_is_recent_as_a_whole(spark, tmp_path):
    root, bronze = str(tmp_path / "lake"), str(tmp_path / "bronze")
    cutoff = NOW - timedelta(days=7)
    for n, shift in enumerate((-5, 5)):
        put(f"{root}/2024/03/03/09-00", f"v7-0000{n}", [raw_row(post_id=f"p{n}")], cutoff + timedelta(seconds=shift))
    put(f"{root}/2024/03/02/09-00", "v7-00000", [raw_row(post_id="old")], cutoff - timedelta(seconds=1))
    assert ids(lake.scan_recent_snapshots(spark, root, now=NOW)) == ["p0", "p1"]
    bronze_store.write_bronze(lake.scan_snapshots(spark, root), bronze)
    assert ids(bronze_store.scan_recent_bronze(spark, bronze, now=NOW)) == ["p0", "p1"]


def test_listing_counts_runs_without_opening_files(spark, tmp_path):
    root = str(tmp_path)
    put(root, "2024/03/01/09-00", [raw_row()])
    put(root, "2024/03/01/18-00", [])
    with open(put(root, "2024/03/02/09-00", []), "w") as f:
        f.write("[{")
    assert lake.lake_runs(spark, root).count() == 3
    assert lake.lake_runs(spark, str(tmp_path / "nowhere")).count() == 0


def test_no_bronze_yet(spark, tmp_path):
    nowhere, empty = str(tmp_path / "nowhere"), tmp_path / "empty"
    empty.mkdir()
    for path in (nowhere, str(empty)):
        assert bronze_store.scan_bronze(spark, path).count() == 0
        assert bronze_store.scan_recent_bronze(spark, path, now=NOW).count() == 0


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(base) and one != two


# --- commits -----------------------------------------------------------------------------

RUN = "2024/03/01/09-00"


def posts(spark, *names):
    return raw_frame(spark, [raw_row(post_id=n) for n in names])


def test_of_two_writers_one_counts_as_a_whole(spark, tmp_path, monkeypatch):
    """A second write begins and ends while the first one is at work."""
    root, commit = str(tmp_path), lake._Folder.commit

    def late(folder, version, documents):
        monkeypatch.setattr(lake._Folder, "commit", commit)
        lake.write_snapshot(posts(spark, "b1", "b2", "b3"), root, RUN, 100)
        commit(folder, version, documents)

    lake.write_snapshot(posts(spark, "old"), root, RUN)
    monkeypatch.setattr(lake._Folder, "commit", late)
    lake.write_snapshot(posts(spark, "a1", "a2"), root, RUN, 100)
    assert ids(lake.scan_snapshots(spark, root)) == ["b1", "b2", "b3"]
    assert lake.lake_runs(spark, root).count() == 1
    folder = lake._Folder(spark, root, RUN)
    with pytest.raises(Exception):  # a version is taken once
        commit(folder, max(folder.versions()), [])


def test_a_killed_write_leaves_the_run(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def killed(folder, version, documents):
        raise RuntimeError("killed")

    for old in ((), ("old",), ("new1", "new2")):
        if old:
            lake.write_snapshot(posts(spark, *old), root, RUN, 100)
        with monkeypatch.context() as patch:
            patch.setattr(lake._Folder, "commit", killed)
            with pytest.raises(RuntimeError):
                lake.write_snapshot(posts(spark, "x", "y", "z"), root, RUN, 100)
        assert ids(lake.scan_snapshots(spark, root)) == sorted(old)
        assert lake.lake_runs(spark, root).count() == bool(old)


def test_a_manifest_cut_short_does_not_count(spark, tmp_path):
    root = str(tmp_path)
    for names in (("a", "b"), ("c", "d")):
        lake.write_snapshot(posts(spark, *names), root, RUN, 100)
    newest = sorted((tmp_path / RUN).glob("*.manifest"))[-1]
    text = newest.read_text()
    for end in (0, 5, len(text) - 1, len(text) - 3, len(text) // 2):
        newest.write_text(text[:end])
        (newest.parent / f".{newest.name}.crc").unlink(missing_ok=True)
        assert ids(lake.scan_snapshots(spark, root)) == ["a", "b"], end
    newest.write_text(text)
    assert ids(lake.scan_snapshots(spark, root)) == ["c", "d"]


def test_a_run_without_rows_is_a_run(spark, tmp_path):
    root = str(tmp_path)
    lake.write_snapshot(posts(spark, "a"), root, RUN)
    lake.write_snapshot(posts(spark, "a").limit(0), root, RUN)
    assert lake.scan_snapshots(spark, root).count() == 0 and lake.lake_runs(spark, root).count() == 1


def test_the_newest_write_counts_whoever_made_it(spark, tmp_path):
    root, later = str(tmp_path), datetime.now(timezone.utc) + timedelta(days=1)
    lake.write_snapshot(posts(spark, "a", "b"), root, RUN, 100)
    put(root, RUN, [raw_row(post_id="foreign")], later)
    assert ids(lake.scan_snapshots(spark, root)) == ["foreign"]
    lake.write_snapshot(posts(spark, "c"), root, RUN)  # above what is there, whatever the clock says
    assert ids(lake.scan_snapshots(spark, root)) == ["c"]


def test_old_writes_are_removed_on_request(spark, tmp_path, monkeypatch):
    root, soon = str(tmp_path), datetime.now(timezone.utc) + timedelta(days=1)
    for names in (("p",), ("a", "b"), ("c", "d")):
        lake.write_snapshot(posts(spark, *names), root, RUN, 100)
    lake.remove_old_writes(spark, root, RUN, soon - timedelta(days=2))
    assert (tmp_path / f"{RUN}.json").exists() and len(list((tmp_path / RUN).glob("_w*"))) == 2
    lake.remove_old_writes(spark, root, RUN, soon)
    left = [p.name for p in (tmp_path / RUN).iterdir() if not p.name.startswith(".")]
    assert len(left) == 2 and not (tmp_path / f"{RUN}.json").exists()
    assert ids(lake.scan_snapshots(spark, root)) == ["c", "d"]
    assert lake.remove_old_writes(spark, root, "2024/03/01/18-00", soon) is None


# --- whole runs --------------------------------------------------------------------------


def test_a_run_delivered_over_three_days_is_whole(spark, tmp_path):
    root, bronze = str(tmp_path / "lake"), str(tmp_path / "bronze")
    cutoff = NOW - timedelta(days=7)
    for day in range(3):
        put(f"{root}/{RUN}", f"part{day}", [raw_row(post_id=f"p{day}")], cutoff - timedelta(days=2 - day))
    put(f"{root}/2024/02/01/09-00", "part0", [raw_row(post_id="old")], cutoff - timedelta(days=1))
    for delivered in range(1, 4):  # as loads of their own
        files = lake.current_files(spark, root).where(F.col("path").contains(f"part{delivered - 1}"))
        bronze_store.write_bronze(lake.scan_files(spark, files), bronze)
    for scan, path in ((lake.scan_recent_snapshots, root), (bronze_store.scan_recent_bronze, bronze)):
        assert ids(scan(spark, path, now=NOW)) == ["p0", "p1", "p2"]
        assert ids(scan(spark, path, now=NOW + timedelta(seconds=1))) == []


def test_unfinished_loads_are_not_there(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    rows = lake.scan_snapshots(spark, lake.write_snapshot(posts(spark, "a"), str(tmp_path / "x"), RUN))
    load = bronze_store.append_load(rows, bronze)
    folder = tmp_path / "bronze" / "rows"
    (folder / f"load={load}").rename(folder / "load=cut-off")
    bronze_store.write_bronze(rows, str(tmp_path / "other"))
    with pytest.raises(Exception):
        bronze_store.scan_bronze(spark, bronze).collect()  # a finished load that is gone is an error
    (folder / "load=cut-off").rename(folder / f"load={load}")
    rows.write.parquet(str(folder / "load=never-finished"))
    assert ids(bronze_store.scan_bronze(spark, bronze)) == ["a"]


# --- documents as lines ------------------------------------------------------------------


def test_one_document_is_read_by_several_tasks(spark, tmp_path):
    root = str(tmp_path)
    many = [raw_row(post_id=str(i), title=f'{i} q"u],[{{}}') for i in range(4000)]
    lake.write_snapshot(posts(spark, "first"), root, RUN)
    lake.write_snapshot(raw_frame(spark, many).coalesce(1), root, RUN, 1 << 30)
    back = lake.scan_snapshots(spark, root)
    files = lake.current_files(spark, root).collect()
    assert len(files) == 1 and files[0]["bytes"] > 500_000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        split = lake.scan_snapshots(spark, root)
        assert split.rdd.getNumPartitions() >= 4
        assert all_rows(split) == all_rows(raw_frame(spark, many)) == all_rows(back)
        assert split.where("author = 'a' AND post_id = '7'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("damage", ["a line", "the last line", "a bracket"])
def test_a_damaged_document_fails_the_scan(spark, tmp_path, damage):
    root = str(tmp_path)
    lake.write_snapshot(posts(spark, "a", "b", "c").coalesce(1), root, RUN)
    lake.write_snapshot(posts(spark, "a", "b", "c").coalesce(1), root, RUN)
    document = next((tmp_path / RUN).glob("_w*/part-*.txt"))
    (document.parent / f".{document.name}.crc").unlink()
    lines = document.read_text().split("\n")
    if damage == "a line":
        lines[2] = "{" + lines[2][1:].replace('"', "x", 1)
    else:
        lines = lines[: -2 if damage == "the last line" else -1]
    document.write_text("\n".join(lines))
    with pytest.raises(Exception):
        lake.scan_snapshots(spark, root).collect()
