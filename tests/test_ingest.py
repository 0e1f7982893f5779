import json
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from checks import events_feed as feed
from pulse.operators import ingest
from pulse.schemas import RAW_COLUMNS, RAW_SCHEMA
from tests.helpers import initial_plan, raw_row

RUN = "2024/01/01/09-00"
LANDED = "run_id string, source string, rank int, item string"
RAW_WITH_RUN = StructType([*RAW_SCHEMA.fields, StructField("run_id", StringType())])


def landed(spark, rows):
    return spark.createDataFrame(
        [(RUN, s, r, i if i is None or isinstance(i, str) else json.dumps(i)) for s, r, i in rows], LANDED
    )


def story(**fields):
    base = {"id": 1, "type": "story", "title": "sql", "url": "u", "score": 3, "descendants": 2, "by": "a", "time": 5}
    return {k: v for k, v in {**base, **fields}.items() if v is not ...}


def normalized(spark, rows, **options):
    df = ingest.normalize_items(landed(spark, rows), **options)
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["post_id"])


def test_limit_counts_before_the_filters(spark):
    rows = [("top", i, story(id=i, type="job" if i < 3 else "story")) for i in range(6)]
    got = normalized(spark, rows, limit=4)
    assert [r["post_id"] for r in got] == ["3"]


def test_ranked_ids(spark):
    df = spark.createDataFrame([(RUN, "top", [9, 7, 8])], "run_id string, source string, ids array<bigint>")
    rows = [(r["rank"], r["id"]) for r in ingest.ranked_ids(df, 2).collect()]
    assert rows == [(0, 9), (1, 7)]


def test_unusable_items_go(spark):
    rows = [
        ("top", 0, None), ("top", 1, "null"), ("top", 2, "{oops"), ("top", 3, story(id=3, type="job")),
        ("top", 4, story(id=4, title="")), ("top", 5, story(id=5, title=None)),
        ("top", 6, story(id=6, title=...)), ("top", 7, story(id=7)),
        ("top", 8, '{"id": 8, "type": "story", "title": "cut off", bad'),
    ]
    assert [r["post_id"] for r in normalized(spark, rows)] == ["7"]


def test_defaults(spark):
    bare = {"id": 4, "type": "story", "title": "About sql"}
    (row,) = normalized(spark, [("best", 0, bare)])
    assert row == {
        "run_id": RUN, "post_id": "4", "source": "best", "title": "About sql", "url": "", "score": 0,
        "num_comments": 0, "author": "", "created_utc": 0, "fetched_at": "2024-01-01T09:00:00+00:00",
        "tool_mentions": '{"sql":"Query Languages"}', "mention_count": 1,
    }


def test_fetch_time_is_one_instant(spark):
    now = datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=timezone.utc)
    rows = [("top", i, story(id=i)) for i in range(3)]
    got = {r["fetched_at"] for r in normalized(spark, rows, fetched_at=now)}
    assert got == {"2024-05-06T07:08:09.123456+00:00"}


def test_first_list_then_better_rank_wins(spark):
    rows = [
        ("best", 0, story(id=1, score=10)), ("top", 9, story(id=1, score=20)), ("top", 12, story(id=1, score=30)),
        ("best", 5, story(id=2, score=40)), ("best", 3, story(id=2, score=50)),
    ]
    got = [(r["post_id"], r["source"], r["score"]) for r in normalized(spark, rows)]
    assert got == [("1", "top", 20), ("2", "best", 50)]


def test_runs_are_deduplicated_apart(spark):
    rows = [(f"2024/01/0{d}/09-00", "top", 0, json.dumps(story())) for d in (1, 2)]
    df = spark.createDataFrame(rows, LANDED)
    assert ingest.normalize_items(df).count() == 2


def test_unlisted_source_loses(spark):
    rows = [("new", 0, story(id=1, score=1)), ("best", 50, story(id=1, score=2))]
    assert [r["score"] for r in normalized(spark, rows)] == [2]


def test_one_hot_post_against_plain_python(spark):
    """A third of all rows are copies of one post."""
    rows = []
    for i in range(3000):
        post = "hot" if i % 3 == 0 else f"p{i % 400}"
        base = raw_row(post_id=post, source=["top", "best", "new"][i % 7 % 3], score=i)
        rows.append((RUN, (i * 37) % 101, *[base[c] for c in RAW_COLUMNS]))
    from pulse.schemas import RAW_SCHEMA

    schema = f"run_id string, rank int, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in RAW_SCHEMA)}"
    df = spark.createDataFrame(rows, schema).repartition(7)
    got = {r["post_id"]: (r["source"], r["rank"], r["score"]) for r in ingest.dedup_first(df).collect()}
    order = {"top": 0, "best": 1}
    want = {}
    for r in rows:
        key = (order.get(r[3], 2), r[1], r[3], r[4], r[5], r[6])
        if r[2] not in want or key < want[r[2]][0]:
            want[r[2]] = (key, (r[3], r[1], r[6]))
    assert got == {k: v[1] for k, v in want.items()}
    assert len(got) == len({r[2] for r in rows})


def test_dedup_prunes_before_its_only_exchange(spark, events):
    plan = initial_plan(ingest.dedup_first(feed.story_copies(events)))
    assert plan.count("Exchange") == 1
    below = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in below


def test_items_are_parsed_once(spark):
    rows = ingest.valid_stories(ingest.decode_items(landed(spark, [("top", 0, story())])))
    assert initial_plan(rows).count("from_json") == 1


def test_union_keeps_duplicates(spark):
    df = landed(spark, [("top", 0, story())])
    assert ingest.union_sources(df, df, df).count() == 3


def test_both_lists_of_the_feed_are_whole(spark, events):
    top, best = feed.landed_items(events)
    types = {r["event_type"]: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert top.count() == sum(types[t] for t in ("view", "click", "signup", "error"))
    assert best.count() == sum(types[t] for t in ("purchase", "signup", "error"))
    assert feed.raw_posts(events).select(F.countDistinct("post_id")).first()[0] == events.count()


def test_latest_of_equal_rows_does_not_depend_on_their_order(spark):
    rows = [{**raw_row(fetched_at=None), "run_id": r} for r in ("2024/01/02/09-00", "2024/01/01/09-00")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame([tuple(r.values()) for r in order], RAW_WITH_RUN).coalesce(1)
        assert [r["run_id"] for r in ingest.dedup_latest(df).collect()] == ["2024/01/01/09-00"]
