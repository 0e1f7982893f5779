import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import events_feed as feed
from pulse.functions.scalars import fetched_timestamp
from pulse.operators.transform import build_mentions, build_posts
from pulse.plans import activity, categories, overview, status, stories, tools, trend
from pulse.schemas import MENTIONS_SCHEMA, POSTS_SCHEMA
from pulse.sources import tables
from tests.helpers import initial_plan, plan_text, raw_frame, raw_row

ON_POSTS = {
    "kpis": overview.overview_kpis, "display": overview.kpis_display, "sources": overview.source_activity,
    "top_posts": overview.top_posts_with_mentions, "stories": stories.top_stories,
    "table": stories.stories_table, "histogram": stories.score_histogram,
    "mentioning": lambda p: stories.posts_mentioning(p, "sql"), "hours": activity.hourly_activity,
    "weekdays": activity.weekday_activity, "ordered": activity.weekday_ordered,
    "scores": activity.positive_scores, "box": activity.score_box, "authors": activity.active_authors,
    "runs": status.recent_runs,
}
ON_MENTIONS = {
    "top": tools.top_tools, "rankings": tools.tool_rankings, "top20": tools.top20_tools,
    "by_source": tools.tool_source_counts, "pivot": tools.tool_source_pivot,
    "summary": categories.category_summary, "share": categories.category_share,
    "list": categories.category_list, "drill": lambda m: categories.category_drilldown(m, "x"),
    "trend": lambda m: trend.rolling_trend(trend.with_fetched_time(m)),
}
ONE_ROW = {"kpis", "display"}


@pytest.fixture(scope="module")
def stored(spark, events, tmp_path_factory):
    return tables.load_tables(feed.raw_posts(events), str(tmp_path_factory.mktemp("tables")))


def posts_of(spark, rows):
    return build_posts(raw_frame(spark, [raw_row(**r) for r in rows]))


@pytest.mark.parametrize("name", ON_POSTS)
def test_posts_reports_on_nothing(spark, name):
    rows = ON_POSTS[name](tables.empty_tables(spark).posts).collect()
    assert len(rows) == (1 if name in ONE_ROW else 0)


@pytest.mark.parametrize("name", ON_MENTIONS)
def test_mentions_reports_on_nothing(spark, name):
    assert ON_MENTIONS[name](tables.empty_tables(spark).mentions).collect() == []


def test_counts_on_nothing(spark):
    empty = tables.empty_tables(spark)
    assert tuple(status.loaded_counts(empty.posts, empty.mentions).first()) == (0, 0)
    assert status.status_totals(empty.posts, empty.mentions).first().asDict() == {
        "total_posts": 0, "total_runs": 0, "total_mentions": 0,
    }
    shown = overview.kpis_display(empty.posts).first().asDict()
    assert [shown[k] for k in overview.KPI_COUNTS] == [0] * 5 and shown["last_fetch"] is None


def test_tables_full_refresh(spark, events, tmp_path):
    root = str(tmp_path / "t")
    assert tables.open_tables(spark, root).posts.count() == 0
    raw = feed.raw_posts(events)
    first = tables.load_tables(raw, root)
    n = (first.posts.count(), first.mentions.count())
    assert n[1] == first.posts.agg(F.sum("mention_count")).first()[0]
    again = tables.load_tables(raw, root)
    assert (again.posts.count(), again.mentions.count()) == n
    # No rows to load: the stored tables stay.
    kept = tables.refresh(raw.limit(0), root)
    assert kept.posts.count() == n[0]
    assert tables.refresh(raw_frame(spark, [raw_row()]), root).posts.count() == 1


def test_failed_load_leaves_the_tables(spark, events, tmp_path):
    root = str(tmp_path / "t")
    raw = feed.raw_posts(events)
    tables.load_tables(raw, root)
    opened = tables.open_tables(spark, root)
    want = sorted(map(str, opened.mentions.collect()))
    broken = raw.withColumn("score", F.expr("if(post_id = '7', raise_error('lost'), score)"))
    with pytest.raises(Exception, match="lost"):
        tables.load_tables(broken, root)
    assert sorted(map(str, tables.open_tables(spark, root).mentions.collect())) == want
    # A frame opened before a refresh still reads its own tables after it.
    tables.load_tables(raw_frame(spark, [raw_row()]), root)
    assert sorted(map(str, opened.mentions.collect())) == want
    assert tables.open_tables(spark, root).posts.count() == 1


def test_sql_on_registered_views(spark, stored):
    stored.register()
    got = spark.sql(
        "SELECT tool, COUNT(*) AS n FROM tool_mentions WHERE category = :c GROUP BY tool",
        args={"c": "Databases"},
    )
    want = categories.category_drilldown(stored.mentions, "Databases").select("tool", "mentions")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_values_are_never_part_of_the_statement(spark, stored):
    assert categories.category_drilldown(stored.mentions, "x' OR '1'='1").count() == 0
    assert stories.top_stories(stored.posts, "x' OR '1'='1").count() == 0
    assert stories.posts_mentioning(stored.posts, "\"} OR '1").count() == 0


def test_latest_fetch_is_the_largest_text(spark):
    posts = posts_of(spark, [{"fetched_at": "2024-01-01T09:00:00+00:00"}, {"fetched_at": None}])
    assert overview.overview_kpis(posts).first()["last_fetch"] == "None"


def test_kpis_against_plain_aggregates(spark, stored):
    want = stored.posts.agg(
        F.count("*"), F.countDistinct("source"), F.countDistinct("author"), F.round(F.avg("score"), 0),
        F.sum("mention_count"), F.max("fetched_at"),
    ).first()
    assert tuple(overview.overview_kpis(stored.posts).first()) == tuple(want)


def test_authors_with_one_post_or_no_name(spark):
    rows = [{"author": a, "score": s} for a, s in [("a", 1), ("a", 3), ("b", 9), ("None", 8), ("None", 8)]]
    got = activity.active_authors(posts_of(spark, rows)).collect()
    assert [tuple(r) for r in got] == [("a", 2, 2.0, 2)]


def test_unknown_weekday_is_null_and_last(spark):
    posts = spark.createDataFrame(
        [("Sunday", 1), ("Someday", 5), ("Monday", 2), ("", 7), (None, 8)], "created_weekday string, score int"
    )
    got = [tuple(r) for r in activity.weekday_ordered(posts).collect()]
    assert got == [("Monday", 1, 1, 2.0), ("Sunday", 7, 1, 1.0), (None, None, 1, 5.0)]


def test_pivot_keeps_a_list_nobody_is_in(spark):
    rows = [("1", "sql", "c", "top", 1, "t"), ("2", "sql", "c", "top", 1, "t"), ("3", "dbt", "c", "top", 1, "t")]
    m = spark.createDataFrame(rows, MENTIONS_SCHEMA)
    got = [r.asDict() for r in tools.tool_source_pivot(m).collect()]
    assert got == [{"tool": "dbt", "best": 0, "top": 1}, {"tool": "sql", "best": 0, "top": 2}]


def test_pivot_keeps_lists_that_are_not_the_usual_ones(spark):
    rows = [("sql", "top"), ("sql", "new"), ("sql", "new"), ("dbt", "best")]
    m = spark.createDataFrame(rows, "tool string, source string")
    got = [r.asDict() for r in tools.tool_source_pivot(m).collect()]
    assert got == [
        {"tool": "dbt", "best": 1, "new": 0, "top": 0}, {"tool": "sql", "best": 0, "new": 2, "top": 1},
    ]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_fetch_times_do_not_depend_on_the_session_zone(spark, zone):
    texts = ["2024-01-31T09:00:00+00:00", "2024-01-31T09:00:00", "2024-01-31T18:00:00+09:00", "2024-01-31", "None"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    stamp = F.unix_seconds(fetched_timestamp(F.col("t")))
    got = [r[0] for r in df.orderBy("i").select(stamp).collect()]
    spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1706691600, 1706691600, 1706691600, 1706659200, None]


def test_bars_grow(spark, stored):
    bars = [r["mentions"] for r in tools.top20_tools(stored.mentions).collect()]
    assert len(bars) == 20 and bars == sorted(bars)
    best = [r["mentions"] for r in tools.tool_rankings(stored.mentions).collect()][:20]
    assert bars[::-1] == best


def test_histogram_of_equal_scores_and_of_the_edge(spark):
    same = posts_of(spark, [{"post_id": str(i), "score": 5} for i in range(3)])
    assert [(r["bin"], r["posts"]) for r in stories.score_histogram(same).collect()] == [(0, 3)]
    spread = posts_of(spark, [{"post_id": str(i), "score": i} for i in range(41)])
    rows = stories.score_histogram(spread).collect()
    assert [r["bin"] for r in rows] == list(range(20))
    assert [r["posts"] for r in rows] == [2] * 19 + [3]
    assert rows[0]["bin_start"] == 0.0 and rows[-1]["bin_end"] == 40.0


def test_term_with_odd_characters(spark):
    rows = [{"post_id": "1", "tool_mentions": '{"c++\\"x": "y"}'}, {"post_id": "2", "tool_mentions": '{"b": "c++"}'}]
    posts = posts_of(spark, rows)
    assert stories.posts_mentioning(posts, 'c++"x').count() == 1
    # A category of that name is no mention.
    assert stories.posts_mentioning(posts, "y").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_box_against_numpy(spark, seed):
    rng = random.Random(seed)
    data = {"top": [rng.randint(1, 10**6) for _ in range(rng.randint(1, 300))]}
    data["best"] = [int(rng.paretovariate(0.7)) + 1 for _ in range(rng.randint(2, 400))] + [77] * 300
    data["one"] = [5]
    rows = [{"source": s, "score": x} for s, xs in data.items() for x in [*xs, 0]]
    got = {r["source"]: r for r in activity.score_box(posts_of(spark, rows)).collect()}
    for source, xs in data.items():
        q1, med, q3 = np.percentile(xs, [25, 50, 75])
        row = got[source]
        assert (row["q1"], row["median"], row["q3"]) == pytest.approx((q1, med, q3), rel=1e-12)
        assert (row["posts"], row["min_score"], row["max_score"]) == (len(xs), min(xs), max(xs))
        reach = 1.5 * (row["q3"] - row["q1"])
        assert row["lower_fence"] == min(x for x in xs if x >= row["q1"] - reach)
        assert row["upper_fence"] == max(x for x in xs if x <= row["q3"] + reach)


def test_trend_against_the_14_windows_of_every_row(spark, stored):
    timed = trend.with_fetched_time(stored.mentions)
    got = trend.rolling_trend(timed)
    direct = (
        timed.groupBy(F.window("fetched_ts", "7 days", "12 hours").alias("w"), "tool", "category")
        .agg(F.count("*").alias("mentions"))
        .select("w.start", "w.end", "tool", "category", "mentions")
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, direct.collect()))


def test_exchanges(spark, stored):
    """One exchange per plain grouping, two with a distinct count; top-k sorts no table."""
    plans = {
        "top": (tools.top_tools(stored.mentions), 1),
        "by_source": (tools.tool_source_counts(stored.mentions), 1),
        "weekdays": (activity.weekday_activity(stored.posts), 1),
        "authors": (activity.active_authors(stored.posts), 1),
        "runs": (status.recent_runs(stored.posts), 1),
        "stories": (stories.top_stories(stored.posts), 0),
        "scores": (activity.positive_scores(stored.posts), 0),
        "distinct": (stored.mentions.groupBy("tool").agg(F.countDistinct("source")), 2),
    }
    for name, (df, exchanges) in plans.items():
        assert initial_plan(df).count("Exchange ") == exchanges, name
    for name in ("top", "authors", "runs", "stories"):
        assert "TakeOrderedAndProject" in plan_text(plans[name][0]), name


def test_key_figures_sort_nothing(spark, stored):
    plan = initial_plan(overview.overview_kpis(stored.posts))
    assert "Sort [" not in plan


def test_box_reads_the_table_once(spark, stored):
    df = activity.score_box(stored.posts)
    df.collect()
    final = plan_text(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 2


def test_columns_of_the_empty_tables(spark):
    empty = tables.empty_tables(spark)
    assert empty.posts.schema == POSTS_SCHEMA and empty.mentions.schema == MENTIONS_SCHEMA


def test_lazy_and_stored_tables_agree(spark, events, stored):
    raw = feed.raw_posts(events)
    assert sorted(map(str, build_posts(raw).collect())) == sorted(map(str, stored.posts.collect()))
    assert sorted(map(str, build_mentions(raw).collect())) == sorted(map(str, stored.mentions.collect()))
