"""A story feed derived from the ``events`` table, whole table in, same rows out.

The derivation uses no clock, no random number and no window, so every row depends on
its own event only and the feed scales with the table.
"""

from pyspark.sql import functions as F

from pulse.functions.mentions import extract_mentions, mentions_json
from pulse.functions.terms import CATEGORIES
from pulse.schemas import RAW_COLUMNS

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
LISTED_TERMS = [name for names in CATEGORIES.values() for name in names]

# Seconds of a half-day per rank: ranks run from 0 to 239.
_RANK_SECONDS = 180

_LIST_SQL = f"split('{','.join(LISTED_TERMS)}', ',')"
# Epoch seconds of a zone-less time, without going through the session zone.
_EPOCH_SQL = (
    "unix_date(CAST(ts AS DATE)) * 86400L + hour(ts) * 3600L + minute(ts) * 60L "
    "+ CAST(floor(second(ts)) AS BIGINT)"
)
_HALF_SQL = "CASE WHEN event_id % 2 = 0 THEN '09-00' ELSE '18-00' END"

_STORY_SQL = {
    "event_id": "event_id",
    "user_id": "user_id",
    "event_type": "event_type",
    "run_id": f"concat(replace(CAST(CAST(ts AS DATE) AS STRING), '-', '/'), '/', {_HALF_SQL})",
    "rank": f"CAST(floor(({_EPOCH_SQL}) % 43200 / {_RANK_SECONDS}) AS INT)",
    "title": f"""
        CASE event_id % 79 % 9
          WHEN 0 THEN concat('Show: ', {_LIST_SQL}[event_id % 78], ' in production')
          WHEN 1 THEN concat('Why we left ', {_LIST_SQL}[event_id % 78], ', again')
          WHEN 2 THEN concat('Notes (', {_LIST_SQL}[event_id % 78], ')')
          WHEN 3 THEN concat({_LIST_SQL}[event_id % 78], ': a retrospective')
          WHEN 4 THEN concat('We moved to ', {_LIST_SQL}[event_id % 78], '.')
          WHEN 5 THEN concat('x', {_LIST_SQL}[event_id % 78], 'y internals')
          WHEN 6 THEN concat(upper({_LIST_SQL}[event_id % 78]), ' and ',
            {_LIST_SQL}[event_id % 78], ' or ', {_LIST_SQL}[(event_id * 7 + 3) % 78])
          WHEN 7 THEN concat('Is it ', {_LIST_SQL}[event_id % 78], '?')
          ELSE 'sklearn, Power BI and torchlight' END""".replace(
        "% 78", f"% {len(LISTED_TERMS)}"
    ),
    "url": "CASE WHEN event_id % 11 = 0 THEN '' "
    "ELSE concat('https://example.org/item/', CAST(event_id AS STRING)) END",
    "score": "CAST(floor(value) AS INT)",
    "num_comments": "CAST(get_json_object(props, '$.k') AS INT)",
    "author": "CASE WHEN event_id % 37 = 0 THEN '[deleted]' WHEN event_id % 41 = 0 THEN '' "
    "WHEN event_id % 43 <> 0 THEN concat('user_', CAST(user_id AS STRING)) END",
    "created_utc": f"CASE WHEN event_id % 47 <> 0 THEN {_EPOCH_SQL} END",
    "fetched_at": "CASE WHEN event_id % 53 <> 0 THEN concat(CAST(CAST(ts AS DATE) AS STRING), "
    "CASE WHEN event_id % 2 = 0 THEN 'T09:00' ELSE 'T18:00' END, ':00+00:00') END",
}


def read_events(spark, sf_dir):
    """The table, spread over all cores.

    It packs into few bytes and row groups, while a story costs far more to make and tag than
    its event to read: as it lies, one task would have a million of them.
    """
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return events.repartition("event_id", "ts", "user_id")


def stream_events(spark, sf_dir):
    # A stream takes a folder or a pattern; the pattern covers a single file as well.
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")


def stories(events):
    return events.selectExpr(*[f"{sql} AS {name}" for name, sql in _STORY_SQL.items()])


def _tagged(events):
    tagged = stories(events).withColumn("mentions", extract_mentions(F.col("title")))
    return tagged.withColumns(
        {
            "post_id": F.expr("CAST(event_id AS STRING)"),
            "source": F.expr("if(event_type IN ('view', 'click', 'signup'), 'top', 'best')"),
            "tool_mentions": F.when(F.expr("event_id % 59 = 0"), "{bad").otherwise(
                mentions_json(F.col("mentions"))
            ),
            "mention_count": F.size("mentions"),
        }
    )


def raw_posts(events):
    """Snapshot rows with their ``run_id``: gaps, nulls and damaged JSON included."""
    return _tagged(events).select("run_id", *RAW_COLUMNS)


def story_copies(events):
    """Ranked snapshot rows in which all events of one user are copies of one story."""
    copies = _tagged(events).withColumn("post_id", F.expr("CAST(user_id AS STRING)"))
    return copies.select("run_id", "rank", *RAW_COLUMNS)


def landed_items(events):
    """Landed rows of both lists, with jobs, missing titles and missing counts.

    Two event types are in both lists, as popular stories are.
    """
    item = """
        CASE WHEN event_id % 29 = 0 THEN 'null' ELSE to_json(struct(
          event_id AS id,
          if(event_id % 13 = 0, 'job', 'story') AS type,
          if(event_id % 17 <> 0, title, NULL) AS title,
          url,
          if(event_id % 19 <> 0, score, NULL) AS score,
          if(event_id % 23 <> 0, num_comments, NULL) AS descendants,
          author AS `by`,
          created_utc AS time)) END AS item"""
    rows = stories(events)

    def listed(source, types, shift):
        return rows.where(f"event_type IN {types}").selectExpr(
            "run_id", f"'{source}' AS source", f"rank + {shift} AS rank", item
        )

    top = listed("top", ("view", "click", "signup", "error"), 0)
    return top, listed("best", ("purchase", "signup", "error"), 7)
