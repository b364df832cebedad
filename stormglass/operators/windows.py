"""Joins by day distance, top rows per group, and neighbours in date order."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormglass.functions.calendar import month

# An event side up to this size is sent to every executor; a larger one is shuffled.
BROADCAST_BYTES = 64 << 20
_FIXED_BYTES_PER_VALUE = 16
#: Windows of so many days are joined by bins of half a window.
MANY_DAYS = 15


@dataclass(frozen=True)
class Extent:
    """In-memory size of an event table, estimated from above, and its first and last date."""

    size: int
    first: datetime.date | None
    last: datetime.date | None


def measure(events: DataFrame, date: str) -> Extent:
    texts = [name for name, kind in events.dtypes if kind == "string"]
    text_bytes = sum((F.coalesce(F.octet_length(F.col(t)), F.lit(0)) for t in texts), F.lit(0))
    row_bytes = text_bytes + _FIXED_BYTES_PER_VALUE * (len(events.columns) + 1)
    size, first, last = events.agg(F.sum(row_bytes), F.min(date), F.max(date)).first()
    return Extent(size or 0, first, last)


def _bin(day: Column, width: int) -> Column:
    # A plain column as join key lets the other side prune partitions by day.
    return day if width == 1 else F.floor(F.unix_date(day) / width)


def listed_by_bin(
    events: DataFrame, event_date: str, low: int, high: int, width: int, by_month: bool = False
) -> DataFrame:
    """The events once per bin of ``width`` days that their window touches (_window_bin), and month if asked for (_window_month)."""

    def place(k: Column) -> Column:
        day = F.date_add(F.col(event_date), k)
        found = _bin(day, width).alias("_window_bin")
        return F.struct(found, month(day).alias("_window_month")) if by_month else F.struct(found)

    touched = F.array_distinct(F.transform(F.sequence(F.lit(low), F.lit(high)), place))
    return events.withColumn("_window", F.explode(touched)).select(*events.columns, "_window.*")


def event_window_join(
    facts: DataFrame,
    fact_date: str,
    events: DataFrame,
    event_date: str,
    low: int,
    high: int,
    offset: str = "days_from_spike",
    broadcast_bytes: int = BROADCAST_BYTES,
    fact_month: str | None = None,
    bin_days: int | None = None,
) -> DataFrame:
    """Inner join of facts to events at most [low, high] days away; adds the day offset.

    A condition on a day distance has no equality, so Spark could only compare every pair. Both sides therefore
    meet in bins of bin_days: an event is listed once per bin that its window touches, a fact is in the bin of its day,
    and the distance is checked behind the equality. Bins of half a window (the default; windows of less than MANY_DAYS take bins
    of a day) list an event about three times, whatever the window, and a fact meets at most half as many events again as it keeps.

    Events must be a staged or otherwise cheap table: its size and date range are measured here.
    The range is a plain filter on the facts, which reaches the file scan. A small event table is
    broadcast, so facts are not shuffled at all and a date holding much of them does no harm; facts
    stored by day are also pruned to the windows (facts stored by month: name the month column).
    A larger one takes a shuffled join, where adaptive execution splits a hot bin.
    """
    days = high - low + 1
    width = bin_days or (days // 2 if days >= MANY_DAYS else 1)
    extent = measure(events, event_date)
    listed = listed_by_bin(events, event_date, low, high, width, fact_month is not None)
    same_bin = _bin(F.col(fact_date), width) == F.col("_window_bin")
    if fact_month:
        same_bin = same_bin & (F.col(fact_month) == F.col("_window_month"))
    distance = F.datediff(F.col(fact_date), F.col(event_date))
    if extent.first is not None:
        facts = facts.filter(
            F.col(fact_date).between(
                F.date_add(F.lit(extent.first), low), F.date_add(F.lit(extent.last), high)
            )
        )
    copies = (days - 2) // width + 2 if days > 1 else 1
    fits = extent.size * copies * (2 if fact_month else 1) <= broadcast_bytes
    listed = F.broadcast(listed) if fits else listed
    joined = facts.join(listed, same_bin & distance.between(low, high))
    return joined.withColumn(offset, distance).drop("_window_bin", "_window_month")


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, buckets: int | None = None,
) -> DataFrame:
    """First n rows of every group.

    Spark limits each task to n rows per group before it shuffles them. With buckets, for a group spread over
    very many tasks, the tasks are dealt to so many buckets, each reduced to n rows before they meet: no row more is
    shuffled first, and a task of that stage gets one bucket's share of a group.
    """
    if buckets:
        bucketed = df.withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(buckets)))
        per_bucket = Window.partitionBy(*group, "_bucket").orderBy(*order)
        ranked = bucketed.withColumn("_rank", F.row_number().over(per_bucket))
        df = ranked.filter(F.col("_rank") <= n).drop("_rank", "_bucket")
    per_group = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(per_group))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def _carried_over_years(rows: DataFrame, date: str, value: Column) -> DataFrame:
    """Per year: the greatest value of the earlier years and the smallest of the later ones.

    Values must grow with the date. One row per calendar year is ordered, not the rows.
    """
    yearly = rows.groupBy(F.year(date).alias("_year")).agg(
        F.min(value).alias("_first"), F.max(value).alias("_last")
    )
    earlier = Window.orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy("_year").rowsBetween(1, Window.unboundedFollowing)
    return yearly.select(
        "_year",
        F.last("_last", True).over(earlier).alias("_before"),
        F.first("_first", True).over(later).alias("_after"),
    )


def previous_row(daily: DataFrame) -> DataFrame:
    """Adds struct _previous: the row before in date order. One row per date, date comes first.

    Ordering happens inside years, with one carried row per year, not in one task.
    """
    row = F.struct(*[F.col(c) for c in daily.columns])
    carried = _carried_over_years(daily, "date", row)
    in_year = Window.partitionBy("_year").orderBy("date")
    lagged = daily.withColumn("_year", F.year("date")).withColumn("_lag", F.lag(row).over(in_year))
    joined = lagged.join(carried, "_year", "left")
    return joined.select(*daily.columns, F.coalesce("_lag", "_before").alias("_previous"))


def nearest_date(wanted: DataFrame, available: DataFrame) -> DataFrame:
    """For every distinct wanted date the closest available one; the earlier of two equals.

    Both inputs hold a DATE column "date". The closest date is either the last one up to the
    wanted date or the first one after it. Both come from an ordering inside years plus one
    carried date per year, so dates are never paired with each other.
    """
    asked = wanted.select("date", F.lit(None).cast("date").alias("have"), F.lit(1).alias("asked"))
    given = available.select("date", F.col("date").alias("have"), F.lit(0).alias("asked"))
    merged = asked.unionByName(given).groupBy("date").agg(
        F.max("have").alias("have"), F.max("asked").alias("asked")
    )
    in_year = Window.partitionBy("_year").orderBy("date")
    located = (
        merged.withColumn("_year", F.year("date"))
        .withColumn("_left", F.last("have", True).over(
            in_year.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_right", F.first("have", True).over(
            in_year.rowsBetween(1, Window.unboundedFollowing)))
        .filter("asked = 1")
        .join(_carried_over_years(merged, "date", F.col("have")), "_year")
        .select("date", F.coalesce("_left", "_before").alias("left"),
                F.coalesce("_right", "_after").alias("right"))
    )
    right_is_closer = F.expr("datediff(right, date) < datediff(date, left)")
    return located.select(
        "date",
        F.when(F.isnull("left") | right_is_closer, F.col("right"))
        .otherwise(F.col("left")).alias("nearest_date"),
    )
