"""Daily tension index, yearly statistics and spikes.

Everything after the first aggregation works on one row per day or per day and category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.functions import measures


def daily_tension(clean: DataFrame) -> DataFrame:
    """Articles, mean negative tone and raw tension per day."""
    daily = clean.groupBy("date").agg(
        F.count("*").alias("total_events"), F.avg("neg_score").alias("avg_negative_tone")
    )
    return daily.withColumn(
        "geo_tension_raw",
        measures.tension_raw(F.col("avg_negative_tone"), F.col("total_events")),
    )


def category_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("date", "category").agg(F.count("*").alias("cat_count"))


def dominant_category(counts: DataFrame, keep_ties: bool = False) -> DataFrame:
    """Most frequent category of a day. One row per day unless ties are asked for."""
    by_count = F.col("cat_count").desc()
    if keep_ties:
        rank = F.rank().over(Window.partitionBy("date").orderBy(by_count))
    else:
        rank = F.row_number().over(Window.partitionBy("date").orderBy(by_count, "category"))
    return counts.withColumn("_rank", rank).filter("_rank = 1").select(
        "date", F.col("category").alias("dominant_category")
    )


def join_dominant_category(daily: DataFrame, dominant: DataFrame) -> DataFrame:
    return daily.join(dominant, "date", "left")


def category_partials(clean: DataFrame) -> DataFrame:
    """Number and sum of scores per day and category: all that is shuffled, whatever a day's share of the articles."""
    return clean.groupBy("date", "category").agg(F.count("*").alias("cat_count"), F.sum("neg_score").alias("neg_sum"))


def profile_of_partials(partials: DataFrame) -> DataFrame:
    """Daily tension and dominant category from one row per day and category."""
    order = F.struct(-F.col("cat_count"), F.col("category"))
    daily = partials.groupBy("date").agg(
        F.sum("cat_count").alias("total_events"),
        (F.sum("neg_sum") / F.sum("cat_count")).alias("avg_negative_tone"),
        F.min_by("category", order).alias("dominant_category"),
    )
    return daily.withColumn(
        "geo_tension_raw",
        measures.tension_raw(F.col("avg_negative_tone"), F.col("total_events")),
    )


def daily_profile(clean: DataFrame) -> DataFrame:
    """Daily tension and dominant category from one pass over the articles."""
    return profile_of_partials(category_partials(clean))


def index_percentiles(daily: DataFrame, accuracy: int | None = None) -> DataFrame:
    """One row with p1 and p99 of the raw tension: exact, or approximate with an accuracy."""
    wanted = F.array(F.lit(V.LOW_PERCENTILE), F.lit(V.HIGH_PERCENTILE))
    if accuracy is None:
        found = F.percentile("geo_tension_raw", wanted)
    else:
        found = F.percentile_approx("geo_tension_raw", wanted, accuracy)
    return daily.agg(found.alias("p")).select(
        F.get("p", F.lit(0)).alias("p1"), F.get("p", F.lit(1)).alias("p99")
    )


#: Parameter k of the sketches: ranks are off by about 2 / k of the days, at least k days are held exactly.
SKETCH_SIZE = 800


def month_sketches(daily: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """A quantile sketch of the raw tension of each month (its first day)."""
    month = F.trunc("date", "month").alias("month")
    return daily.groupBy(month).agg(F.kll_sketch_agg_double("geo_tension_raw", F.lit(size)).alias("sketch"))


def percentiles_of_sketches(sketches: DataFrame) -> DataFrame:
    """One row with p1 and p99 of all months, from their merged sketches; NULL without any."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("s"), F.count("*").alias("n"))
    found = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(rank))).alias(name)
             for name, rank in (("p1", V.LOW_PERCENTILE), ("p99", V.HIGH_PERCENTILE))]
    return merged.select(*found)


def normalize_index(daily: DataFrame, percentiles: DataFrame) -> DataFrame:
    """Adds the 0..10 index; the two percentiles enter the plan as scalar subqueries."""
    low = percentiles.select("p1").scalar()
    high = percentiles.select("p99").scalar()
    return daily.withColumn(
        "geo_tension_index", measures.normalize_0_10(F.col("geo_tension_raw"), low, high)
    )


def year_stats(index: DataFrame) -> DataFrame:
    return index.groupBy(F.year("date").alias("year")).agg(
        F.avg("geo_tension_index").alias("year_mean"),
        F.stddev_samp("geo_tension_index").alias("year_std"),
    )


def join_year_stats(index: DataFrame, sigmas: float = V.SPIKE_SIGMAS) -> DataFrame:
    """Adds year statistics and the spike threshold: a window of at most 366 rows per year."""
    year = Window.partitionBy("year")
    return (
        index.withColumn("year", F.year("date"))
        .withColumn("year_mean", F.avg("geo_tension_index").over(year))
        .withColumn("year_std", F.stddev_samp("geo_tension_index").over(year))
        .withColumn("threshold", F.col("year_mean") + sigmas * F.col("year_std"))
    )


def filter_spike(with_threshold: DataFrame) -> DataFrame:
    return with_threshold.filter("geo_tension_index > threshold").withColumn(
        "is_spike", F.lit(True)
    )


INDEX_COLUMNS = ["date", "geo_tension_index", "total_events", "dominant_category"]
SPIKE_COLUMNS = [
    "date", "geo_tension_index", "total_events", "threshold", "is_spike", "dominant_category",
]


def spike_events(index: DataFrame, sigmas: float = V.SPIKE_SIGMAS) -> DataFrame:
    return filter_spike(join_year_stats(index, sigmas)).select(*SPIKE_COLUMNS)


def top_spikes(spikes: DataFrame, n: int = 10) -> DataFrame:
    return spikes.orderBy(F.col("geo_tension_index").desc(), "date").limit(n)
