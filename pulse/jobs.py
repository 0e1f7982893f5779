"""The scheduled jobs, also from the command line.

    python -m pulse.jobs ingest  --items s3a://b/landed/run --lake s3a://b/raw --run-id 2024/01/31/09-00
    python -m pulse.jobs bronze  --lake s3a://b/raw --bronze s3a://b/bronze --state s3a://b/state
    python -m pulse.jobs refresh --lake s3a://b/raw --tables s3a://b/tables
    python -m pulse.jobs refresh --bronze s3a://b/bronze --tables s3a://b/tables --changed
    python -m pulse.jobs show    --tables s3a://b/tables --page overview
    python -m pulse.jobs show    --tables s3a://b/tables --page stories --source best --out s3a://b/out
    python -m pulse.jobs rollup  --bronze s3a://b/bronze --sums s3a://b/sums
    python -m pulse.jobs rollup  --bronze s3a://b/bronze --sums s3a://b/sums --show --days 7
    python -m pulse.jobs trend   --tables s3a://b/tables --out s3a://b/trend
    python -m pulse.jobs trend   --tables s3a://b/tables --out s3a://b/trend --state s3a://b/trend-state
"""

import argparse
from datetime import datetime, timezone

from pyspark.sql import functions as F

from pulse.operators.ingest import normalize_items
from pulse.plans import stories, trend
from pulse.plans.dashboard import PAGES
from pulse.plans.status import loaded_counts
from pulse.schemas import MENTIONS_SCHEMA
from pulse.session import build_session
from pulse.sources import bronze as bronze_store
from pulse.sources import rollup as sums
from pulse.sources import snapshots as lake
from pulse.sources import tables
from pulse.streaming import trend as stream_trend
from pulse.streaming.ingest import LATE_DAYS, ingest_new

LANDED_SCHEMA = "source string, rank int, item string"


def read_landed(spark, path, run_id):
    """Landed items of one run: JSON lines of list, place and the story object.

    A damaged line fails the job: its rank would be null and the rank limit would drop it.
    """
    lines = spark.read.schema(LANDED_SCHEMA).option("mode", "FAILFAST").json(path)
    return lines.withColumn("run_id", F.lit(run_id))


def ingest_run(spark, items, lake_root, run_id, now=None):
    """One run: landed items to one snapshot; every row carries the same fetch time."""
    landed = read_landed(spark, items, run_id)
    posts = normalize_items(landed, fetched_at=now or datetime.now(timezone.utc))
    return lake.write_snapshot(posts, lake_root, run_id)


def refresh_tables(spark, tables_root, lake_root=None, local_root="data/raw", bronze=None,
                   days=lake.RECENT_DAYS, now=None, compat=True, dedup=None, changed=False):
    """Rebuild both tables from the snapshots of the last days.

    ``bronze`` reads the Parquet form of the lake and is the way at scale; with ``changed``
    only days whose runs changed are built again. ``dedup`` compares all days, so it needs a
    full refresh.
    """
    if changed:
        if not bronze or dedup:
            raise ValueError("a refresh of changed days reads bronze and does not deduplicate")
        return tables.refresh_days(spark, bronze, tables_root, days, now, compat)
    if bronze:
        raw = bronze_store.scan_recent_bronze(spark, bronze, days, now)
    else:
        raw = lake.load_snapshots(spark, lake_root, local_root, days, now)
    return tables.refresh(raw, tables_root, compat=compat, dedup=dedup)


def show_frames(frames, out=None, rows=None):
    """Print every frame in full, or its first ``rows``; with ``out`` write them instead."""
    for name, frame in frames.items():
        if out:
            frame.write.mode("overwrite").json(f"{out.rstrip('/')}/{name}")
        else:
            print(name)
            frame.show(max(1, rows or frame.count()), truncate=False)


def write_trend(spark, tables_root, out, state=None, stores=stream_trend.STATE_PARTITIONS):
    """The moving 7-day trend over the stored mentions.

    With ``state`` it runs as a stream over the current copy of the table and adds the
    windows that closed since the last start; a refresh starts a new copy, so a stream's
    state belongs to one load.
    """
    mentions = tables.open_tables(spark, tables_root).mentions
    if not state:
        trend.rolling_trend(trend.with_fetched_time(mentions)).write.mode("overwrite").parquet(out)
        return out
    session = stream_trend.state_session(spark, stores)
    stream = session.readStream.schema(MENTIONS_SCHEMA).parquet(
        tables.mentions_path(spark, tables_root)
    )
    return stream_trend.run_trend(stream, out, state)


def main(argv=None):
    parser = argparse.ArgumentParser(prog="pulse.jobs")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest")
    ingest.add_argument("--items", required=True)
    ingest.add_argument("--lake", required=True)
    ingest.add_argument("--run-id", required=True)

    bronze = commands.add_parser("bronze")
    bronze.add_argument("--lake", required=True)
    bronze.add_argument("--bronze", required=True)
    bronze.add_argument("--state", required=True)
    bronze.add_argument("--late-days", type=int, default=LATE_DAYS, help="days listed again for late files")
    bronze.add_argument("--all", action="store_true", help="list the whole lake")

    refresh = commands.add_parser("refresh")
    refresh.add_argument("--lake")
    refresh.add_argument("--local", default="data/raw")
    refresh.add_argument("--bronze")
    refresh.add_argument("--tables", required=True)
    refresh.add_argument("--days", type=int, default=lake.RECENT_DAYS)
    refresh.add_argument("--dedup", choices=["latest"])
    refresh.add_argument("--changed", action="store_true", help="only days whose runs changed")

    show = commands.add_parser("show")
    show.add_argument("--tables", required=True)
    show.add_argument("--page", choices=list(PAGES))
    show.add_argument("--category", help="drill-down of the categories page")
    show.add_argument("--source", default=stories.ALL_SOURCES, help="list of the stories page")
    show.add_argument("--term", help="posts that mention a term")
    show.add_argument("--rows", type=int, help="print only so many rows of each frame")
    show.add_argument("--out", help="write the frames here as JSON lines instead")

    folded = commands.add_parser("rollup")
    folded.add_argument("--bronze", required=True)
    folded.add_argument("--sums", required=True)
    folded.add_argument("--show", action="store_true", help="print the reports of the sums")
    folded.add_argument("--days", type=int, help="only runs of the last days")
    folded.add_argument("--category", help="drill-down of this category")
    folded.add_argument("--rows", type=int, help="print only so many rows of each frame")
    folded.add_argument("--out", help="write the frames here as JSON lines instead")

    moving = commands.add_parser("trend")
    moving.add_argument("--tables", required=True)
    moving.add_argument("--out", required=True)
    moving.add_argument("--state", help="run as a stream with its state here")
    moving.add_argument("--stores", type=int, default=stream_trend.STATE_PARTITIONS)

    args = parser.parse_args(argv)
    spark = build_session(f"pulse-{args.command}")
    if args.command == "ingest":
        print(ingest_run(spark, args.items, args.lake, args.run_id))
    elif args.command == "bronze":
        late_days = None if args.all else args.late_days
        print(ingest_new(spark, args.lake, args.bronze, args.state, late_days=late_days))
    elif args.command == "refresh":
        loaded = refresh_tables(
            spark, args.tables, args.lake, args.local, args.bronze, args.days, dedup=args.dedup,
            changed=args.changed,
        )
        loaded_counts(loaded.posts, loaded.mentions).show()
    elif args.command == "rollup":
        sums.update_rollup(spark, args.bronze, args.sums)
        if args.show or args.out:
            opened = sums.open_rollup(spark, args.bronze, args.sums, args.days)
            show_frames(sums.reports(opened, args.category), args.out, args.rows)
    elif args.command == "trend":
        print(write_trend(spark, args.tables, args.out, args.state, args.stores))
    else:
        opened = tables.open_tables(spark, args.tables)
        frames = {}
        if args.page:
            options = {"categories": {"category": args.category}, "stories": {"source": args.source}}
            page = PAGES[args.page]
            frames = page(opened.posts, opened.mentions, **options.get(args.page, {}))
        if args.term:
            frames["mentioning"] = stories.posts_mentioning(opened.posts, args.term)
        show_frames(frames, args.out, args.rows)


if __name__ == "__main__":
    main()
