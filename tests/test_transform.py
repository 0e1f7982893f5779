import pytest
from pyspark.sql import functions as F

from pulse.functions import scalars as S
from pulse.operators.transform import build_mentions, build_posts, clean_authors, mentions_from_posts
from pulse.schemas import MENTIONS_SCHEMA, POSTS_SCHEMA
from tests.helpers import initial_plan, raw_frame, raw_row


def one(spark, compat=True, **fields):
    return build_posts(raw_frame(spark, [raw_row(**fields)]), compat).first()


@pytest.mark.parametrize("author", ["[deleted]", "[removed]", "", None])
def test_absent_authors_go(spark, author):
    rows = [raw_row(author=author), raw_row(author="None"), raw_row(author="b")]
    kept = [r["author"] for r in clean_authors(raw_frame(spark, rows)).collect()]
    assert kept == ["None", "b"]


@pytest.mark.parametrize(
    "epoch, date, hour, weekday",
    [
        (0, "1970-01-01", 0, "Thursday"),
        (-1, "1969-12-31", 23, "Wednesday"),
        (1704067199, "2023-12-31", 23, "Sunday"),
        (1704067200, "2024-01-01", 0, "Monday"),
        (253402300799, "9999-12-31", 23, "Friday"),
        (253402300800, None, None, None),
        (10**12, None, None, None),
        (-(10**12), None, None, None),
        (None, None, None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_created_parts(spark, epoch, date, hour, weekday, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = one(spark, compat=False, created_utc=epoch)
        assert (row["created_date"], row["created_hour"], row["created_weekday"]) == (date, hour, weekday)
        row = one(spark, compat=True, created_utc=epoch)
        assert row["created_date"] == (date or "None")
        assert row["created_hour"] == (hour or 0)
        assert row["created_weekday"] == (weekday or "")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_null_rendering(spark):
    row = one(spark, post_id=None, source=None, title=None, url=None, score=None, num_comments=None, fetched_at=None)
    assert row["post_id"] == "None" and row["fetched_at"] == "None"
    assert row["source"] == "top"
    assert row["title"] == "" and row["url"] == ""
    assert (row["score"], row["num_comments"], row["engagement_score"]) == (0, 0, 0.0)
    row = one(spark, compat=False, post_id=None, fetched_at=None)
    assert row["post_id"] is None and row["fetched_at"] is None


def test_engagement_matches_plain_rounding(spark):
    pairs = [(a, b) for a in range(0, 900, 7) for b in range(0, 500, 11)]
    df = spark.createDataFrame(pairs, "a int, b int")
    rows = df.select("a", "b", S.engagement_score(F.col("a"), F.col("b")).alias("e")).collect()
    assert all(r["e"] == round(r["a"] * 0.6 + r["b"] * 0.4, 2) for r in rows)


def test_truncation_counts_code_points(spark):
    row = one(spark, title="😀" * 301, url="é" * 600)
    assert row["title"] == "😀" * 300
    assert row["url"] == "é" * 500


def test_mention_count_is_recomputed(spark):
    row = one(spark, tool_mentions='{"a": "x", "b": "y"}', mention_count=9)
    assert row["mention_count"] == 2
    assert row["tool_mentions"] == '{"a":"x","b":"y"}'
    assert one(spark, tool_mentions="{bad", mention_count=9)["mention_count"] == 0


def test_mentions_table(spark):
    rows = [
        raw_row(post_id="1", tool_mentions='{"a":"x","b":"y","a":"z"}', score=5, source="best"),
        raw_row(post_id="2", tool_mentions="{}"),
        raw_row(post_id="3", tool_mentions='{"a":"x"}', author=None),
        raw_row(post_id=None, tool_mentions='{"q":null}', fetched_at=None),
    ]
    raw = raw_frame(spark, rows)
    got = sorted(tuple(r) for r in build_mentions(raw).collect())
    stamp = "2024-01-01T09:00:00+00:00"
    assert got == [
        ("1", "a", "z", "best", 5, stamp),
        ("1", "b", "y", "best", 5, stamp),
        ("None", "q", "None", "top", 1, "None"),
    ]
    assert sorted(tuple(r) for r in mentions_from_posts(build_posts(raw)).collect()) == got


def test_snapshots_count_per_run_unless_latest(spark):
    rows = [
        raw_row(post_id="1", fetched_at="2024-01-01T09:00:00+00:00", score=1),
        raw_row(post_id="1", fetched_at="2024-01-02T09:00:00+00:00", score=2),
        raw_row(post_id="1", fetched_at=None, score=3),
        raw_row(post_id="2"),
    ]
    raw = raw_frame(spark, rows)
    assert build_posts(raw).count() == 4
    latest = {r["post_id"]: r["score"] for r in build_posts(raw, dedup="latest").collect()}
    assert latest == {"1": 2, "2": 1}
    with pytest.raises(ValueError):
        build_posts(raw, dedup="first")


def test_schemas(spark):
    raw = raw_frame(spark, [raw_row()])
    def shape(schema):
        return [(f.name, f.dataType) for f in schema]
    assert shape(build_posts(raw).schema) == shape(POSTS_SCHEMA)
    assert shape(build_mentions(raw).schema) == shape(MENTIONS_SCHEMA)


def test_building_is_one_narrow_stage(spark, events):
    from checks.events_feed import raw_posts

    raw = raw_posts(events)
    for df in (build_posts(raw), build_mentions(raw)):
        plan = initial_plan(df)
        assert "Exchange" not in plan and "Python" not in plan
    # The map is built once: the optimizer adds no emptiness test on it.
    assert initial_plan(build_mentions(raw)).count("from_json") == 1


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "posts")
    build_posts(raw_frame(spark, [raw_row()])).write.parquet(path)
    plan = initial_plan(mentions_from_posts(spark.read.schema(POSTS_SCHEMA).parquet(path)))
    assert "title" not in plan and "url" not in plan
    assert "GreaterThan(mention_count,0)" in plan


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), ("12.9", 12), ("-3.7", -3), ("NaN", 0), ("x", 0), ("", 0), (None, 0), ("inf", 0)],
)
def test_safe_int(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(S.safe_int(F.col("c")).alias("n")).first()["n"] == expected


def test_same_without_ansi_mode(spark, events):
    from checks.events_feed import raw_posts

    odd = raw_frame(spark, [raw_row(title=None, tool_mentions=t) for t in (None, "[]", '{"a":"x","a":"y"}')])
    def rows():
        return [
            sorted(map(str, build(raw).collect()))
            for raw in (raw_posts(events), odd)
            for build in (build_posts, build_mentions)
        ]
    strict = rows()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert rows() == strict
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
