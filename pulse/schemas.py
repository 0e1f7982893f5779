"""Explicit schemas: nothing in this package infers a schema from data."""

from pyspark.sql import types as T

_STR, _INT, _LONG, _DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _schema(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# One story object as the feed serves it.
ITEM_SCHEMA = _schema(
    ("id", _LONG),
    ("type", _STR),
    ("title", _STR),
    ("url", _STR),
    ("score", _INT),
    ("descendants", _INT),
    ("by", _STR),
    ("time", _LONG),
)

# One element of a snapshot's JSON array.
RAW_SCHEMA = _schema(
    ("post_id", _STR),
    ("source", _STR),
    ("title", _STR),
    ("url", _STR),
    ("score", _INT),
    ("num_comments", _INT),
    ("author", _STR),
    ("created_utc", _LONG),
    ("fetched_at", _STR),
    ("tool_mentions", _STR),
    ("mention_count", _INT),
)

POSTS_SCHEMA = _schema(
    ("post_id", _STR),
    ("source", _STR),
    ("title", _STR),
    ("url", _STR),
    ("score", _INT),
    ("num_comments", _INT),
    ("engagement_score", _DBL),
    ("author", _STR),
    ("created_date", _STR),
    ("created_hour", _INT),
    ("created_weekday", _STR),
    ("fetched_at", _STR),
    ("tool_mentions", _STR),
    ("mention_count", _INT),
)

MENTIONS_SCHEMA = _schema(
    ("post_id", _STR),
    ("tool", _STR),
    ("category", _STR),
    ("source", _STR),
    ("score", _INT),
    ("fetched_at", _STR),
)

RAW_COLUMNS = RAW_SCHEMA.names
POSTS_COLUMNS = POSTS_SCHEMA.names
MENTIONS_COLUMNS = MENTIONS_SCHEMA.names
