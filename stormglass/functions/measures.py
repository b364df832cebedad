"""Column expressions of the risk measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stormglass import fixed_values as V


def tension_raw(avg_negative: Column, articles: Column) -> Column:
    return avg_negative * F.ln(articles + F.lit(1))


def normalize_0_10(raw: Column, low: Column, high: Column) -> Column:
    """Position of raw between two percentiles, clamped to 0..10; NULL when they are equal."""
    scaled = F.try_divide(raw - low, high - low) * V.INDEX_MAX
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(V.INDEX_MAX), scaled))
    return F.when(scaled.isNotNull(), clamped)


def return_pct(close: Column, base: Column) -> Column:
    return F.try_divide(close - base, base) * 100


def weighted(weight: Column, value: Column) -> Column:
    return weight * value / 100


def risk_level(score: Column, mean: Column, std: Column) -> Column:
    return (
        F.when(score > mean + V.SPIKE_SIGMAS * std, "High")
        .when(score > mean + V.MEDIUM_RISK_SIGMAS * std, "Medium")
        .otherwise("Low")
    )


def bar_width(value: Column, largest: Column) -> Column:
    """Length of a bar in pixels, relative to the largest absolute value."""
    width = F.try_divide(F.abs(value), largest) * V.BAR_PIXELS
    return F.coalesce(F.floor(width).cast("int"), F.lit(0))
