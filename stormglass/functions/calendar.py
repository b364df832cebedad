"""Column expressions on dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormglass import fixed_values as V

NANOSECONDS_PER_DAY = 86_400_000_000_000


def news_date(text: Column) -> Column:
    """Day of a yyyyMMddHHmmss text; NULL when it is shorter than a day or no date."""
    day = F.when(F.length(text) >= 8, F.substring(text, 1, 8))
    return F.try_to_timestamp(day, F.lit("yyyyMMdd")).cast("date")


def news_time(text: Column) -> Column:
    """Timestamp of a yyyyMMddHHmmss text; NULL when it is none."""
    return F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))


def month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def epoch_ns_to_date(nanoseconds: Column) -> Column:
    """UTC day of an epoch value, whatever the zone of the session."""
    whole = nanoseconds.cast("bigint")
    midnight = whole - F.pmod(whole, F.lit(NANOSECONDS_PER_DAY))
    days = F.call_function("div", midnight, F.lit(NANOSECONDS_PER_DAY))
    return F.date_from_unix_date(days.cast("int"))


def market_open(utc_time: Column) -> Column:
    """New York exchange hours: Monday to Friday, 09:30 until before 16:00."""
    local = F.from_utc_timestamp(utc_time, V.NEW_YORK)
    minutes = F.hour(local) * 60 + F.minute(local)
    return (F.weekday(local) < 5) & minutes.between(9 * 60 + 30, 16 * 60 - 1)


def clock(time: Column) -> Column:
    return F.date_format(time, "HH:mm 'UTC'")


def day_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")
