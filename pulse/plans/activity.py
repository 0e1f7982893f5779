"""When the community posts, how scores spread, who posts most."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulse.functions.scalars import weekday_ordinal
from pulse.plans.common import ROWS, most_first, row_count

TOP_AUTHORS = 15
NOT_AUTHORS = ["", "None"]
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
WHISKER = 1.5

# A block holds at most 2^12 different scores.
_BLOCK_BITS = 12


def hourly_activity(posts, measures=ROWS):
    return (
        posts.where(F.col("created_hour").isNotNull())
        .groupBy("created_hour")
        .agg(measures.rows("posts"), measures.mean_score("avg_score"))
        .orderBy("created_hour")
    )


def weekday_activity(posts, measures=ROWS):
    return (
        posts.where(F.col("created_weekday").isNotNull() & (F.col("created_weekday") != ""))
        .groupBy("created_weekday")
        .agg(measures.rows("posts"), measures.mean_score("avg_score"))
    )


def weekday_ordered(posts, measures=ROWS):
    """Weekday activity from Monday to Sunday; an unknown name becomes null and last."""
    ordinal = weekday_ordinal(F.col("created_weekday"))
    return (
        weekday_activity(posts, measures)
        .select(
            F.when(ordinal.isNotNull(), F.col("created_weekday")).alias("created_weekday"),
            ordinal.alias("weekday_ordinal"),
            "posts",
            "avg_score",
        )
        .orderBy(F.asc_nulls_last("weekday_ordinal"))
    )


def positive_scores(posts, keep=()):
    return posts.where(F.col("score") > 0).select(*keep, "source", "score")


def active_authors(posts, limit=TOP_AUTHORS, measures=ROWS):
    return (
        posts.where(~F.col("author").isin(NOT_AUTHORS))
        .groupBy("author")
        .agg(
            measures.rows("posts"),
            measures.mean_score("avg_score"),
            F.sum("num_comments").alias("total_comments"),
        )
        .where(F.col("posts") > 1)
        .orderBy(*most_first("avg_score", "author"))
        .limit(limit)
    )


def score_quartiles(counts):
    """Exact linear quartiles per list from ``(source, score, n)``.

    ``percentile`` would keep all different scores of a list in one buffer. Here a
    first pass ranks blocks of neighbouring scores and a second ranks the scores inside
    the few blocks a quartile falls into, so no task sees more rows of a list than
    there are blocks or than a block has scores.
    """
    block = F.shiftright("score", _BLOCK_BITS)
    blocks = counts.groupBy("source", block.alias("block")).agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("source")
    ranked = blocks.select(
        "source",
        "block",
        F.sum("n").over(whole.orderBy("block")).alias("upto"),
        F.sum("n").over(whole).alias("total"),
        "n",
    ).withColumn("before", F.col("upto") - F.col("n"))

    # A quartile lies between two neighbouring ranks; each has a row in its block.
    shares = [F.struct(F.lit(k).alias("name"), F.lit(v).alias("share")) for k, v in QUARTILES.items()]
    sides = [F.struct(F.lit(0).alias("side")), F.struct(F.lit(1).alias("side"))]
    place = F.col("share") * (F.col("total") - 1)
    targets = (
        ranked.select("*", F.inline(F.array(*shares)))
        .select("*", F.inline(F.array(*sides)))
        .withColumn("fraction", place - F.floor(place))
        .withColumn("rank", F.when(F.col("side") == 0, F.floor(place)).otherwise(F.ceil(place)))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
        .select(
            F.col("source").alias("t_source"), F.col("block").alias("t_block"),
            "before", "name", "side", "rank", "fraction",
        )
    )

    inside = Window.partitionBy("source", "t_block", "name", "side").orderBy("score")
    reached = (
        counts.join(
            F.broadcast(targets),  # at most six rows per list
            counts["source"].eqNullSafe(F.col("t_source")) & block.eqNullSafe(F.col("t_block")),
        )
        .withColumn("seen", F.col("before") + F.sum("n").over(inside))
        .where(F.col("seen") > F.col("rank"))
    )

    def at(name, side):
        chosen = (F.col("name") == name) & (F.col("side") == side)
        return F.min(F.when(chosen, F.col("score")))

    def between(name):
        fraction = F.max(F.when(F.col("name") == name, F.col("fraction")))
        return (at(name, 0) + (at(name, 1) - at(name, 0)) * fraction).alias(name)

    return reached.groupBy("source").agg(*[between(name) for name in QUARTILES])


def score_box(posts):
    """Box statistics of the positive scores per list.

    The fences are the outermost scores within 1.5 quartile distances of the box. The
    joins are null-safe so that no side gets a filter of its own and all of them read
    the counts from one exchange.
    """
    return box_of_counts(positive_scores(posts).groupBy("source", "score").agg(row_count("n")))


def box_of_sums(scores):
    """The same from any number of ``(source, score, n)`` per list and score."""
    return box_of_counts(scores.groupBy("source", "score").agg(F.sum("n").alias("n")))


def box_of_counts(counts):
    """The same from one ``(source, score, n)`` per list and score."""
    quartiles = score_quartiles(counts).withColumnRenamed("source", "q_source")
    # one row per list
    box = counts.join(F.broadcast(quartiles), counts["source"].eqNullSafe(F.col("q_source")))
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    score = F.col("score")
    return box.groupBy("source", *QUARTILES).agg(
        F.sum("n").alias("posts"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.min(F.when(score >= F.col("q1") - reach, score)).alias("lower_fence"),
        F.max(F.when(score <= F.col("q3") + reach, score)).alias("upper_fence"),
    )
