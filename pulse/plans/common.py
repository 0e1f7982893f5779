"""Expressions the reports share."""

from pyspark.sql import functions as F


class Measures:
    """What a report counts, over rows of posts or mentions."""

    def rows(self, name):
        return F.count(F.lit(1)).alias(name)

    def mean_score(self, name):
        return F.round(F.avg("score"), 0).alias(name)


class SumMeasures(Measures):
    """The same over sums of such rows: ``n`` rows, ``scored`` of them with a score, and
    ``score`` their sum (see ``pulse.sources.rollup``)."""

    def rows(self, name):
        return F.coalesce(F.sum("n"), F.lit(0)).alias(name)

    def mean_score(self, name):
        return F.round(F.try_divide(F.sum("score"), F.sum("scored")), 0).alias(name)


ROWS, SUMS = Measures(), SumMeasures()


def row_count(name):
    return ROWS.rows(name)


def most_first(measure, *then):
    """Largest first; the further columns make the order total."""
    return [F.desc_nulls_last(measure), *[F.asc_nulls_last(c) for c in then]]


def side_by_side(first, second):
    """Two one-row frames as one row."""
    both = first.unionByName(second, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
