"""Calendar expressions over `yyyyMMdd` text."""

import datetime as dt

from pyspark.sql import Column, functions as F


def local_time(value: dt.datetime) -> Column:
    """A time without a zone as a literal. It goes by way of text: a datetime object would be moved
    from the Python process's zone to the session's."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def today() -> Column:
    """The processing date as `yyyyMMdd`."""
    return F.date_format(F.current_date(), "yyyyMMdd")


def valid_day(day: Column) -> Column:
    return F.coalesce(day.rlike(r"^[0-9]{8}\z"), F.lit(False)) & F.try_to_date(
        day, "yyyyMMdd"
    ).isNotNull()


def calendar_buckets(day: Column, iso_year: bool = False) -> Column:
    """`array<struct<cf, cq>>` with the day, month and week bucket, in that order.

    The week bucket is the calendar year followed by the ISO week without padding, so `20160101`
    falls in `201653` and `20160110` in `20161`. With `iso_year=True` it is the ISO year and a
    two-digit week. Null when the day is not a date.
    """
    date = F.try_to_date(day, "yyyyMMdd")
    week = F.weekofyear(date)
    if iso_year:
        weekly = F.concat(
            F.extract(F.lit("YEAROFWEEK"), date).cast("string"), F.lpad(week.cast("string"), 2, "0")
        )
    else:
        weekly = F.concat(F.substring(day, 1, 4), week.cast("string"))

    def bucket(family: str, qualifier: Column) -> Column:
        return F.struct(F.lit(family).alias("cf"), qualifier.alias("cq"))

    buckets = F.array(
        bucket("daily", day), bucket("monthly", F.substring(day, 1, 6)), bucket("weekly", weekly)
    )
    return F.when(valid_day(day), buckets)
