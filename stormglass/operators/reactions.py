"""Prices in spike windows: returns against day 0 and their aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.functions import calendar, measures
from stormglass.operators.windows import event_window_join


def prices_wide_to_long(wide: DataFrame, date: str = "Date") -> DataFrame:
    """One column per ticker to one row per day and ticker; missing closes are dropped."""
    tickers = [F.col(f"`{c}`").cast("double").alias(c) for c in wide.columns if c != date]
    narrow = wide.select(calendar.epoch_ns_to_date(F.col(date)).alias("date"), *tickers)
    names = [F.col(f"`{c}`") for c in wide.columns if c != date]
    long = narrow.unpivot("date", names, "ticker", "close")
    return long.filter(F.col("close").isNotNull() & ~F.isnan("close") & F.col("date").isNotNull())


def as_spike_keys(spikes: DataFrame) -> DataFrame:
    return spikes.select(
        F.col("date").alias("spike_date"), "geo_tension_index", "dominant_category"
    )


def window_prices(
    prices: DataFrame, spikes: DataFrame, low: int = V.PRICE_WINDOW[0],
    high: int = V.PRICE_WINDOW[1], **join_options,
) -> DataFrame:
    """Every price in the window around every spike, with its day offset."""
    joined = event_window_join(
        prices, "date", as_spike_keys(spikes), "spike_date", low, high, **join_options
    )
    return joined.select(
        "spike_date", "geo_tension_index", "dominant_category",
        F.col("date").alias("price_date"), "ticker", "close", "days_from_spike",
    )


def reaction_cells(windowed: DataFrame) -> DataFrame:
    """Returns per spike, ticker and day offset, ready to be summed further.

    A return compares a close with every day-0 close of the same spike and ticker. Normally there
    is one; if copies exist, the mean over all pairs is the mean close times the mean inverse base,
    and the lowest return lies at an end of both ranges. So closes are first reduced per
    cell (before the shuffle, in each task) and the day-0 cell is then spread over at most one
    row per offset. No pair is built and no close is lost.
    """
    inverse = F.when(F.col("close") != 0, F.try_divide(F.lit(1.0), F.col("close")))
    keys = ["spike_date", "dominant_category", "ticker", "days_from_spike"]
    cells = windowed.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.avg("close").alias("_mean"),
        F.min("close").alias("_low"),
        F.max("close").alias("_high"),
        F.count(inverse).alias("_usable"),
        F.sum(inverse).alias("_inv_sum"),
        F.min(inverse).alias("_inv_low"),
        F.max(inverse).alias("_inv_high"),
    )
    per_ticker = Window.partitionBy("spike_date", "ticker")

    def at_day_0(name: str):
        return F.max(F.when(F.col("days_from_spike") == 0, F.col(name))).over(per_ticker)

    based = cells.select(
        *keys, "_n", "_mean", "_low", "_high",
        at_day_0("_n").alias("_base_n"),
        at_day_0("_mean").alias("_base_mean"),
        at_day_0("_usable").alias("_base_usable"),
        at_day_0("_inv_sum").alias("_base_inv"),
        at_day_0("_inv_low").alias("_u_low"),
        at_day_0("_inv_high").alias("_u_high"),
    ).filter("_base_n IS NOT NULL")
    one_base = (F.col("_base_n") == 1) & (F.col("_base_usable") == 1)
    exact = measures.return_pct(F.col("_mean"), F.col("_base_mean"))
    mean_ratio = F.try_divide(F.col("_mean") * F.col("_base_inv"), F.col("_base_usable"))
    lowest_ratio = F.least(
        *[F.col(c) * F.col(u) for c in ("_low", "_high") for u in ("_u_low", "_u_high")]
    )
    return based.select(
        *keys,
        F.when(one_base, exact).otherwise((mean_ratio - 1) * 100).alias("avg_return_pct"),
        F.when(one_base & (F.col("_n") == 1), exact)
        .otherwise((lowest_ratio - 1) * 100).alias("min_return_pct"),
        (F.col("_n") * F.col("_base_n")).alias("num_obs"),
        (F.col("_n") * F.col("_base_usable")).alias("valid_obs"),
    )


def join_day0_base(windowed: DataFrame) -> DataFrame:
    """Row-level form: each price with its day-0 close and return; rows without one are dropped.

    Prices must be unique per day and ticker (as prices_wide_to_long gives them), so a window
    holds one row per offset.
    """
    per_ticker = Window.partitionBy("spike_date", "ticker")
    base = F.max(F.when(F.col("days_from_spike") == 0, F.col("close"))).over(per_ticker)
    based = windowed.withColumn("close_day0", base).filter("close_day0 IS NOT NULL")
    return based.withColumn("return_pct", measures.return_pct(F.col("close"), F.col("close_day0")))


def reaction_by_spike(cells: DataFrame) -> DataFrame:
    return cells.select(
        "spike_date", "dominant_category", "ticker", "days_from_spike", "avg_return_pct", "num_obs"
    )


def _mean_return(condition=None):
    returns = F.col("avg_return_pct") * F.col("valid_obs")
    seen = F.when(F.col("avg_return_pct").isNotNull(), F.col("valid_obs"))
    if condition is not None:
        returns, seen = F.when(condition, returns), F.when(condition, seen)
    return F.try_divide(F.sum(returns), F.sum(seen))


def ticker_summary(cells: DataFrame) -> DataFrame:
    """Per ticker: mean return on day 5 and 30, lowest return, number of observations."""
    offset = F.col("days_from_spike")
    return cells.groupBy("ticker").agg(
        _mean_return(offset == 5).alias("avg_return_5d"),
        _mean_return(offset == 30).alias("avg_return_30d"),
        F.min("min_return_pct").alias("worst_drawdown"),
        F.sum("num_obs").alias("num_events"),
    )


def reaction_curve(cells: DataFrame) -> DataFrame:
    return cells.groupBy("ticker", "days_from_spike").agg(
        _mean_return().alias("avg_return_pct"), F.sum("num_obs").alias("num_events")
    )
