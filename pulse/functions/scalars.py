"""Scalar expressions of the cleaning step. All of them ignore the session time zone."""

from pyspark.sql import functions as F

# Weights of votes and comments, text limits, absent authors.
SCORE_WEIGHT = 0.6
COMMENT_WEIGHT = 0.4
TITLE_LIMIT = 300
URL_LIMIT = 500
ABSENT_AUTHORS = ["[deleted]", "[removed]", ""]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Epoch seconds of the first and the last second a four-digit year can name.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799
_DAY = 86400
_HOUR = 3600


def or_zero(col):
    return F.coalesce(col, F.lit(0))


def or_blank(col):
    return F.coalesce(col, F.lit(""))


def present_author(author):
    return author.isNotNull() & ~author.isin(ABSENT_AUTHORS)


def engagement_score(score, comments):
    return F.round(score * F.lit(SCORE_WEIGHT) + comments * F.lit(COMMENT_WEIGHT), 2)


def _valid_epoch(epoch):
    return F.when(epoch.between(_FIRST_SECOND, _LAST_SECOND), epoch)


def _weekdays():
    return F.split(F.lit(",".join(WEEKDAYS)), ",")


def _epoch_day(epoch):
    return F.floor(_valid_epoch(epoch) / F.lit(_DAY)).cast("int")


def created_date(epoch):
    return F.date_from_unix_date(_epoch_day(epoch)).cast("string")


def created_hour(epoch):
    return F.floor(F.pmod(_valid_epoch(epoch), F.lit(_DAY)) / F.lit(_HOUR)).cast("int")


def created_weekday(epoch):
    # Day 0 of the epoch was a Thursday. ``get`` is null at a null place; in ANSI mode
    # ``element_at`` on a constant array is not.
    return F.get(_weekdays(), F.pmod(_epoch_day(epoch) + F.lit(3), F.lit(7)))


def weekday_ordinal(weekday):
    """1 for Monday up to 7 for Sunday, null for anything else."""
    place = F.array_position(_weekdays(), weekday).cast("int")
    return F.when(place > 0, place)


def truncate_title(title):
    return F.substring(or_blank(title), 1, TITLE_LIMIT)


def truncate_url(url):
    return F.substring(or_blank(url), 1, URL_LIMIT)


def run_instant(run_id):
    """ISO-8601 UTC text of a run id ``YYYY/MM/DD/HH-MM``."""
    return F.concat(
        F.translate(F.substring(run_id, 1, 10), "/", "-"),
        F.lit("T"),
        F.translate(F.substring(run_id, 12, 5), "-", ":"),
        F.lit(":00+00:00"),
    )


def fetched_timestamp(fetched_at):
    """Instant of an ISO-8601 text, null where the text is not one; UTC where it has no zone."""
    zoned = fetched_at.rlike(r":\d{2}(\.\d+)? ?(Z|[+-]\d{2}(:?\d{2})?)$")
    day = fetched_at.rlike(r"^\d{4}-\d{2}-\d{2}$")
    utc = F.concat(fetched_at, F.when(day, "T00:00:00Z").otherwise("Z"))
    return F.when(zoned, fetched_at).otherwise(utc).try_cast("timestamp")


def safe_int(col):
    """Whole number for display: null, NaN and unparsable values count as 0."""
    number = col.try_cast("double")
    return or_zero(F.when(~F.isnan(number), number).try_cast("bigint"))
