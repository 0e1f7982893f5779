
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import events_feed as feed  # noqa: E402
from checks import oracle  # noqa: E402
from checks.lake_times import set_times  # noqa: E402
from pulse.functions import scalars as S  # noqa: E402
from pulse.functions.mentions import (  # noqa: E402
    extract_mentions, mentions_json, parse_mentions,
)
from pulse.functions.terms import (  # noqa: E402
    BLOCKED_TERMS, CATEGORIES, MIN_TERM_LENGTH, SUBSTRING_NEEDLES, TermDictionary,
)
from pulse.operators import ingest, transform  # noqa: E402
from pulse.plans import activity, categories, overview, status, stories, tools, trend  # noqa: E402
from pulse.schemas import RAW_COLUMNS  # noqa: E402
from pulse.session import shared_folder  # noqa: E402
from pulse.sources import bronze as bronze_store  # noqa: E402
from pulse.sources import rollup  # noqa: E402
from pulse.sources import snapshots as lake  # noqa: E402
from pulse.sources import tables  # noqa: E402
from pulse.streaming import ingest as stream_ingest  # noqa: E402
from pulse.streaming import trend as stream_trend  # noqa: E402

try:  # the subpackage may be left out; nothing else depends on it
    from pulse.llm import queries as llm_queries
except ImportError as missing:
    if missing.name not in ("pulse.llm", "corpus_pipeline"):
        raise
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
# The lake queries write the runs before this one first.
LATER_RUNS = "2024/01/16"


def _events(spark, sf_dir):
    return feed.read_events(spark, sf_dir)


def _raw(spark, sf_dir):
    return feed.raw_posts(_events(spark, sf_dir))


def _on_posts(plan, **options):
    def run(spark, sf_dir):
        return plan(transform.build_posts(_raw(spark, sf_dir)), **options)

    return run


def _on_mentions(plan, **options):
    def run(spark, sf_dir):
        return plan(transform.build_mentions(_raw(spark, sf_dir)), **options)

    return run


def _on_both(plan):
    def run(spark, sf_dir):
        raw = _raw(spark, sf_dir)
        return plan(transform.build_posts(raw), transform.build_mentions(raw))

    return run


def _on_raw(plan):
    return lambda spark, sf_dir: plan(_raw(spark, sf_dir))


def _on_items(plan):
    def run(spark, sf_dir):
        events = _events(spark, sf_dir)
        return plan(ingest.union_sources(*feed.landed_items(events)))

    return run


# --- ingest and cleaning, one operator at a time ---------------------------------------


def _rank_limit(landed):
    return ingest.rank_limit(landed).groupBy("source", "run_id", "rank").agg(
        F.count(F.lit(1)).alias("items")
    )


def _valid_stories(landed):
    return ingest.valid_stories(ingest.decode_items(landed))


def _union_sources(landed):
    return landed.groupBy("source").agg(
        F.count(F.lit(1)).alias("items"), F.countDistinct("run_id").alias("runs")
    )


def _extract_mentions(spark, sf_dir):
    rows = feed.stories(_events(spark, sf_dir))
    return rows.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.explode(extract_mentions(F.col("title"))).alias("tool", "category"),
    )


def _document_mentions(spark, sf_dir):
    """The same tagging on whole documents, with common words added to the terms."""
    words = TermDictionary.build(
        {**CATEGORIES, **oracle.COMMON_WORDS}, SUBSTRING_NEEDLES, BLOCKED_TERMS, MIN_TERM_LENGTH
    )
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return documents.select(
        "doc_id", F.explode(extract_mentions(F.col("text"), words)).alias("tool", "category")
    )


def _mention_count(raw):
    return raw.select("post_id", "title", "mention_count")


def _dedup_first(spark, sf_dir):
    copies = feed.story_copies(_events(spark, sf_dir))
    return ingest.dedup_first(copies).select("run_id", "rank", *RAW_COLUMNS)


def _dedup_latest(spark, sf_dir):
    copies = feed.story_copies(_events(spark, sf_dir)).select(*RAW_COLUMNS, "run_id")
    return ingest.dedup_latest(copies)


def _clean_authors(raw):
    return transform.clean_authors(raw).select("post_id", "author")


def _created_parts(raw):
    epoch = F.col("created_utc")
    return raw.select(
        "post_id",
        "created_utc",
        S.created_date(epoch).alias("created_date"),
        S.created_hour(epoch).alias("created_hour"),
        S.created_weekday(epoch).alias("created_weekday"),
    )


def _fill_counts(landed):
    return ingest.decode_items(landed).where(F.col("id").isNotNull()).select(
        F.col("id").cast("string").alias("post_id"),
        "source",
        S.or_zero(F.col("score")).alias("score"),
        S.or_zero(F.col("descendants")).alias("num_comments"),
    )


def _engagement_score(raw):
    score = S.engagement_score(F.col("score"), F.col("num_comments"))
    return raw.select("post_id", score.alias("engagement_score"))


def _parse_mentions(raw):
    parsed = raw.select("post_id", parse_mentions(F.col("tool_mentions")).alias("mentions"))
    return parsed.select(
        "post_id",
        mentions_json(F.col("mentions")).alias("tool_mentions"),
        F.size("mentions").alias("mention_count"),
    )


def _truncate_text(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        S.truncate_title(F.col("text")).alias("title"),
        S.truncate_url(F.col("text")).alias("url"),
        F.length("text").alias("n_chars"),
    )


# --- snapshot lake, tables and streams -------------------------------------------------


def _snapshot_rows(df):
    return df.select("run_id", *RAW_COLUMNS)


def _scan_snapshots(spark, sf_dir):
    root = lake.write_snapshots(_raw(spark, sf_dir), shared_folder(spark, "lake"))
    return _snapshot_rows(lake.scan_snapshots(spark, root))


def _two_arrivals(spark, sf_dir):
    """A lake whose later runs arrived a day later, and the cutoff in between."""
    raw = _raw(spark, sf_dir)
    root = shared_folder(spark, "lake")
    early, late = F.col("run_id") < LATER_RUNS, F.col("run_id") >= LATER_RUNS
    arrived = datetime(2024, 2, 1, tzinfo=timezone.utc)
    for name, rows, days in (("early", early, 0), ("late", late, 3)):
        lake.write_snapshots(raw.where(rows), f"{root}/{name}")
        set_times(spark, f"{root}/{name}", arrived + timedelta(days=days))
    return root, arrived + timedelta(days=2 + lake.RECENT_DAYS)


def _scan_recent(spark, sf_dir):
    root, now = _two_arrivals(spark, sf_dir)
    return _snapshot_rows(lake.scan_recent_snapshots(spark, root, now=now))


def _scan_recent_bronze(spark, sf_dir):
    root, now = _two_arrivals(spark, sf_dir)
    bronze = bronze_store.write_bronze(
        lake.scan_snapshots(spark, root), shared_folder(spark, "bronze")
    )
    return _snapshot_rows(bronze_store.scan_recent_bronze(spark, bronze, now=now))


def _write_snapshot(spark, sf_dir):
    """The whole feed as one run, far above the usual size of a run."""
    root = shared_folder(spark, "lake")
    lake.write_snapshot(_raw(spark, sf_dir), root, "2024/02/01/09-00")
    return _snapshot_rows(lake.scan_snapshots(spark, root))


def _run_count(spark, sf_dir):
    root = lake.write_snapshots(_raw(spark, sf_dir), shared_folder(spark, "lake"))
    return status.run_count(lake.lake_runs(spark, root))


def _incremental_ingest(spark, sf_dir):
    """Two arrivals, an ingest after each and one more that finds nothing new."""
    raw = _raw(spark, sf_dir)
    root, bronze = shared_folder(spark, "lake"), shared_folder(spark, "bronze")
    checkpoint = shared_folder(spark, "ingest-state")
    early, late = F.col("run_id") < LATER_RUNS, F.col("run_id") >= LATER_RUNS
    lake.write_snapshots(raw.where(early), f"{root}/early")
    stream_ingest.ingest_new(spark, root, bronze, checkpoint)
    lake.write_snapshots(raw.where(late), f"{root}/late")
    for _ in range(2):
        stream_ingest.ingest_new(spark, root, bronze, checkpoint)
    return _snapshot_rows(bronze_store.scan_bronze(spark, bronze))


def _rewritten_ingest(spark, sf_dir):
    """A run that is written again with other rows after it was ingested."""
    raw = _raw(spark, sf_dir)
    root, bronze = shared_folder(spark, "lake"), shared_folder(spark, "bronze")
    checkpoint = shared_folder(spark, "ingest-state")
    for rows in (F.col("run_id") < LATER_RUNS, F.col("run_id") >= LATER_RUNS):
        lake.write_snapshot(raw.where(rows), root, "2024/02/01/09-00")
        stream_ingest.ingest_new(spark, root, bronze, checkpoint)
    return _snapshot_rows(bronze_store.scan_bronze(spark, bronze))


def _load_posts(spark, sf_dir):
    return tables.load_tables(_raw(spark, sf_dir), shared_folder(spark, "tables")).posts


def _load_mentions(spark, sf_dir):
    return tables.load_tables(_raw(spark, sf_dir), shared_folder(spark, "tables")).mentions


def _loaded_counts(spark, sf_dir):
    loaded = tables.load_tables(_raw(spark, sf_dir), shared_folder(spark, "tables"))
    return status.loaded_counts(loaded.posts, loaded.mentions)


def _first_run(raw):
    # of the distinct runs: the minimum of a text column leaves hash aggregation
    return raw.select("run_id").distinct().agg(F.min("run_id")).first()[0]


def _refresh_days(spark, sf_dir):
    """Two arrivals and a refresh of changed days after each; the second corrects a run."""
    raw = _raw(spark, sf_dir)
    root, bronze, state, stored = (
        shared_folder(spark, n) for n in ("lake", "bronze", "ingest-state", "tables")
    )
    wrong = _first_run(raw)
    early, late = F.col("run_id") < LATER_RUNS, F.col("run_id") >= LATER_RUNS
    first = raw.where(early).unionByName(raw.where(F.col("run_id") == wrong))
    lake.write_snapshots(first, f"{root}/early")
    stream_ingest.ingest_new(spark, root, bronze, state)
    tables.refresh_days(spark, bronze, stored)
    lake.write_snapshots(raw.where(late), f"{root}/late")
    lake.write_snapshot(raw.where(F.col("run_id") == wrong), root, wrong)
    stream_ingest.ingest_new(spark, root, bronze, state)
    return tables.refresh_days(spark, bronze, stored)


def _on_sums(name):
    """A report from sums that were updated before and after a run was corrected."""

    def run(spark, sf_dir):
        raw = _raw(spark, sf_dir)
        bronze, stored = shared_folder(spark, "bronze"), shared_folder(spark, "sums")
        wrong = _first_run(raw)
        for number, rows in enumerate(
            (
                raw.where(F.col("run_id") <= LATER_RUNS).where("NOT score <=> 1"),
                raw.where((F.col("run_id") <= LATER_RUNS) & (F.col("run_id") != wrong)),
                raw.where((F.col("run_id") > LATER_RUNS) | (F.col("run_id") == wrong)),
            )
        ):
            arrived = F.lit(datetime(2024, 2, 1 + number, tzinfo=timezone.utc))
            rows = rows.withColumns({"modified_at": arrived, "version": F.lit(number).cast("bigint")})
            bronze_store.write_bronze(rows, bronze)
            rollup.update_rollup(spark, bronze, stored)
        return rollup.reports(rollup.open_rollup(spark, bronze, stored))[name]

    return run


def _load_posts_nulls(raw):
    return transform.build_posts(raw, compat=False)


def _window_seconds(windows):
    return windows.select(
        F.unix_seconds("window_start").alias("window_start"),
        F.unix_seconds("window_end").alias("window_end"),
        "tool",
        "category",
        "mentions",
    )


def _rolling_trend(mentions):
    return _window_seconds(trend.rolling_trend(trend.with_fetched_time(mentions)))


def _rolling_trend_stream(spark, sf_dir):
    session = stream_trend.state_session(spark)
    mentions = transform.build_mentions(feed.raw_posts(feed.stream_events(session, sf_dir)))
    path = stream_trend.run_trend(
        mentions, shared_folder(spark, "trend"), shared_folder(spark, "trend-state")
    )
    return _window_seconds(spark.read.parquet(path))


# --- the contract ----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Most mentioned tools on the smallest scale."""
    return queries()["top_tools"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator and report, over whole tables."""
    more = llm_queries.queries() if llm_queries else {}
    return {
        **more,
        # ingest
        "rank_limit": _on_items(_rank_limit),
        "valid_stories": _on_items(_valid_stories),
        "union_sources": _on_items(_union_sources),
        "normalize_items": _on_items(ingest.normalize_items),
        "extract_mentions": _extract_mentions,
        "document_mentions": _document_mentions,
        "mention_count": _on_raw(_mention_count),
        "dedup_first": _dedup_first,
        "dedup_latest": _dedup_latest,
        # lake
        "scan_snapshots": _scan_snapshots,
        "scan_recent_snapshots": _scan_recent,
        "scan_recent_bronze": _scan_recent_bronze,
        "write_snapshot": _write_snapshot,
        "incremental_ingest": _incremental_ingest,
        "rewritten_ingest": _rewritten_ingest,
        "run_count": _run_count,
        # cleaning and tables
        "clean_authors": _on_raw(_clean_authors),
        "created_parts": _on_raw(_created_parts),
        "fill_counts": _on_items(_fill_counts),
        "engagement_score": _on_raw(_engagement_score),
        "parse_mentions": _on_raw(_parse_mentions),
        "truncate_text": _truncate_text,
        "load_posts": _load_posts,
        "load_posts_nulls": _on_raw(_load_posts_nulls),
        "load_mentions": _load_mentions,
        "loaded_counts": _loaded_counts,
        "refresh_days_posts": lambda spark, sf_dir: _refresh_days(spark, sf_dir).posts,
        "refresh_days_mentions": lambda spark, sf_dir: _refresh_days(spark, sf_dir).mentions,
        # reports from sums per run
        **{f"sums_{name}": _on_sums(name) for name in oracle.SUM_REPORTS if name != "rolling_trend"},
        "sums_rolling_trend": lambda spark, sf_dir: _window_seconds(
            _on_sums("rolling_trend")(spark, sf_dir)
        ),
        # overview
        "overview_kpis": _on_posts(overview.overview_kpis),
        "kpis_display": _on_posts(overview.kpis_display),
        "top_tools": _on_mentions(tools.top_tools),
        "source_activity": _on_posts(overview.source_activity),
        "top_posts_with_mentions": _on_posts(overview.top_posts_with_mentions),
        # tools
        "tool_rankings": _on_mentions(tools.tool_rankings),
        "top20_tools": _on_mentions(tools.top20_tools),
        "tool_source_counts": _on_mentions(tools.tool_source_counts),
        "tool_source_pivot": _on_mentions(tools.tool_source_pivot),
        # categories
        "category_summary": _on_mentions(categories.category_summary),
        "category_share": _on_mentions(categories.category_share),
        "category_list": _on_mentions(categories.category_list),
        "category_drilldown": _on_mentions(
            categories.category_drilldown, category="Data Engineering"
        ),
        # stories
        "top_stories": _on_posts(stories.top_stories),
        "top_stories_by_source": _on_posts(stories.top_stories, source="best"),
        "stories_table": _on_posts(stories.stories_table),
        "score_histogram": _on_posts(stories.score_histogram),
        "posts_mentioning": _on_posts(stories.posts_mentioning, term="spark"),
        "posts_mentioning_r": _on_posts(stories.posts_mentioning, term="r"),
        # activity
        "hourly_activity": _on_posts(activity.hourly_activity),
        "weekday_activity": _on_posts(activity.weekday_activity),
        "weekday_ordered": _on_posts(activity.weekday_ordered),
        "positive_scores": _on_posts(activity.positive_scores),
        "score_box": _on_posts(activity.score_box),
        "active_authors": _on_posts(activity.active_authors),
        # status and trend
        "status_totals": _on_both(status.status_totals),
        "recent_runs": _on_posts(status.recent_runs),
        "rolling_trend": _on_mentions(_rolling_trend),
        "rolling_trend_stream": _rolling_trend_stream,
    }


def oracle_sql() -> dict[str, str]:
    """The same results as DuckDB SQL over the same tables."""
    return {**oracle.statements(), **(llm_queries.oracle_sql() if llm_queries else {})}
