"""ISO dates in documents, and epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted form, yyyy-MM-dd[THH:mm[:ss[.S...]][Z|+hh:mm|-hh:mm]].
ISO_DATE = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?\z"
# Fixed value: the tail that says which zone a date-time is in.
ZONE = r"T.*(Z|[+-]\d{2}:\d{2})\z"


def iso_timestamp(text: Column) -> Column:
    """A timestamp from ISO text, null if it is not one. No zone means UTC.

    The pattern comes first because a cast alone would read ``T10:00`` as today.
    """
    # yyyy-MM-ddTHH:mm is 16 characters; a cast wants seconds before a zone.
    timed = F.when(
        (F.length(text) > 10) & (F.substring(text, 17, 1) != ":"),
        F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 6)),
    ).otherwise(text)
    zoned = (
        F.when(text.rlike(ZONE), timed)
        .when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(F.concat(timed, F.lit("Z")))
    )
    return F.when(text.rlike(ISO_DATE), zoned.try_cast("timestamp"))


def utc_day(ts: Column) -> Column:
    """The UTC day of a timestamp, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int"))


def utc_midnight(day: Column) -> Column:
    """The timestamp at which a day starts in UTC."""
    return F.timestamp_seconds(F.unix_date(day).cast("bigint") * F.lit(86400))


def zoneless_as_utc(value: Column) -> Column:
    """A timestamp without a zone, taken as UTC whatever the session time zone."""
    return F.concat(value.cast("string"), F.lit("Z")).cast("timestamp")


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)
