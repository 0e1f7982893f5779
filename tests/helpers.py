"""Small builders the tests share."""

from pulse.schemas import RAW_SCHEMA

DEFAULTS = {
    "post_id": "1",
    "source": "top",
    "title": "t",
    "url": "u",
    "score": 1,
    "num_comments": 1,
    "author": "a",
    "created_utc": 0,
    "fetched_at": "2024-01-01T09:00:00+00:00",
    "tool_mentions": "{}",
    "mention_count": 0,
}


def raw_row(**fields):
    return {**DEFAULTS, **fields}


def raw_frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in RAW_SCHEMA.names) for r in rows], RAW_SCHEMA)


def plan_text(df):
    """The executed plan; the final one if the frame ran before."""
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(df):
    return plan_text(df).split("== Initial Plan ==")[-1]
