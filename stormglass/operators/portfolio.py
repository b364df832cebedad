"""Portfolio exposure and the current risk reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.functions import measures
from stormglass.operators.windows import previous_row

MEASURES = ["avg_return_5d", "avg_return_30d", "worst_drawdown"]


def join_portfolio_reactions(
    portfolio: DataFrame, summary: DataFrame, missing_as_zero: bool = False
) -> DataFrame:
    """Every holding with its reaction statistics; unknown tickers keep NULL or get 0."""
    joined = portfolio.join(summary, "ticker", "left")
    return joined.fillna(0.0, subset=MEASURES) if missing_as_zero else joined


def portfolio_risk(holdings: DataFrame) -> DataFrame:
    return holdings.agg(
        *[
            F.sum(measures.weighted(F.col("weight"), F.col(m))).alias(f"weighted_{m}")
            for m in MEASURES
        ]
    )


def exposure_scores(holdings: DataFrame) -> DataFrame:
    score = measures.weighted(F.col("weight"), F.abs("worst_drawdown"))
    return holdings.select(
        "ticker", "weight", "avg_return_5d", "worst_drawdown", score.alias("exposure_score")
    )


def exposure_ranking(holdings: DataFrame) -> DataFrame:
    return exposure_scores(holdings).orderBy(F.col("exposure_score").desc_nulls_last(), "ticker")


def most_exposed(holdings: DataFrame) -> DataFrame:
    return exposure_ranking(holdings).select("ticker", "exposure_score").limit(1)


def weight_check(portfolio: DataFrame) -> DataFrame:
    """Data quality: the sum of weights and whether it is 100."""
    total = F.sum("weight")
    return portfolio.agg(total.alias("total_weight"), (total == 100).alias("is_complete"))


def day_over_day_change(index: DataFrame) -> DataFrame:
    """Change of the index against the day before in date order."""
    pairs = previous_row(index.select("date", "geo_tension_index"))
    return pairs.select(
        "date", "geo_tension_index",
        (F.col("geo_tension_index") - F.col("_previous.geo_tension_index")).alias("change"),
    )


def last_two_days(index: DataFrame) -> DataFrame:
    return index.orderBy(F.col("date").desc()).limit(2)


def global_risk_stats(index: DataFrame) -> DataFrame:
    """Mean, deviation and thresholds over the whole history."""
    stats = index.agg(
        F.avg("geo_tension_index").alias("mean"), F.stddev_samp("geo_tension_index").alias("std")
    )
    return stats.select(
        "mean", "std",
        (F.col("mean") + V.SPIKE_SIGMAS * F.col("std")).alias("high_threshold"),
        (F.col("mean") + V.MEDIUM_RISK_SIGMAS * F.col("std")).alias("medium_threshold"),
    )


def with_risk_level(index: DataFrame, stats: DataFrame) -> DataFrame:
    return index.withColumn(
        "risk_level",
        measures.risk_level(
            F.col("geo_tension_index"), stats.select("mean").scalar(), stats.select("std").scalar()
        ),
    )


def latest_reading(index: DataFrame) -> DataFrame:
    """One row: last day, its score, change and number of events (0 if unknown)."""
    ends = last_two_days(index).agg(
        F.max("date").alias("date"),
        F.max_by("geo_tension_index", "date").alias("current_score"),
        F.min_by("geo_tension_index", "date").alias("_previous"),
        F.count("*").alias("_days"),
        F.coalesce(F.max_by("total_events", "date"), F.lit(0)).alias("events_today"),
    )
    change = F.when(F.col("_days") == 2, F.col("current_score") - F.col("_previous"))
    return ends.select("date", "current_score", change.alias("delta_score"), "events_today")


def risk_snapshot(index: DataFrame, holdings: DataFrame) -> DataFrame:
    """The figures of the live page in one row."""
    stats = global_risk_stats(index)
    mean, std = stats.select("mean").scalar(), stats.select("std").scalar()
    risk = portfolio_risk(holdings)
    return latest_reading(index).select(
        "*",
        measures.risk_level(F.col("current_score"), mean, std).alias("risk_level"),
        risk.select("weighted_avg_return_5d").scalar().alias("weighted_avg_return_5d"),
        risk.select("weighted_worst_drawdown").scalar().alias("weighted_worst_drawdown"),
        most_exposed(holdings).select("ticker").scalar().alias("most_exposed"),
    )
