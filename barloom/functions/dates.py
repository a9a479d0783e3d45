"""Date and time coercions, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone news times are shown in, and the shape of a feed date without its day name.
DISPLAY_ZONE = "Asia/Singapore"
DISPLAY_FORMAT = "yyyy-MM-dd HH:mm"
FEED_FORMATS = ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss")


def to_date_or_null(c: Column) -> Column:
    """Date from epoch seconds or from text."""
    text = c.cast("string")
    seconds = text.try_cast("double")
    return F.when(seconds.isNotNull(), F.to_date(F.timestamp_seconds(seconds))).otherwise(F.to_date(F.try_to_timestamp(text)))


def feed_time(c: Column) -> Column:
    """Timestamp of a feed date such as ``Tue, 02 Jan 2024 10:20:30 GMT``; ISO text is read too."""
    plain = F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(f)) for f in FEED_FORMATS], F.try_to_timestamp(plain))


def epoch_day(seconds: Column) -> Column:
    return F.to_date(F.timestamp_seconds(seconds))


def display_time(ts: Column) -> Column:
    """Minutes in the display zone; empty without a time."""
    return F.coalesce(F.date_format(F.from_utc_timestamp(ts, DISPLAY_ZONE), DISPLAY_FORMAT), F.lit(""))


def sort_key(published: Column) -> Column:
    return F.coalesce(published, F.lit(0))
