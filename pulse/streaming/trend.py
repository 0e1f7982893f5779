"""The moving 7-day trend as a stream that keeps its own state."""

from pulse.plans.trend import rolling_trend, with_fetched_time

LATENESS = "1 day"
STATE_PARTITIONS = 8


def state_session(spark, partitions=STATE_PARTITIONS):
    """A sibling session for stateful streams.

    The number of state stores is fixed by the first start of a stream and should follow
    the cluster and the dictionary; the state is a few counts per tool and window.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def trend_stream(mentions, lateness=LATENESS):
    """Closed windows of a mention stream; rows later than ``lateness`` are ignored."""
    timed = with_fetched_time(mentions).withWatermark("fetched_ts", lateness)
    return rolling_trend(timed)


def run_trend(mentions, path, checkpoint, lateness=LATENESS):
    """Process what is there, append the windows that closed, then stop."""
    query = (
        trend_stream(mentions, lateness)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return path
