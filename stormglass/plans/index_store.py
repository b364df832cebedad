"""The tension index kept up to date: a load adds its own partial sums, and the index follows from the stored ones.

Partial sums per day and category are segments with a manifest (see streaming/segments.py). Sums are decimals, so loads in any
number and order give the same sums as one pass over all articles. Month sketches of the raw tension are made anew for the months
that a load touches; percentiles come from the merged sketches or, exactly, from the daily table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.operators import tension
from stormglass.plans.jobs import Index, classified_raw_news, spike_events
from stormglass.session import stage
from stormglass.sources import news as news_source
from stormglass.sources import tables
from stormglass.streaming.segments import FAN, Kind, Manifest, Store

_SUM = "decimal(38,16)"


def _added_up(partials: DataFrame) -> DataFrame:
    summed = partials.groupBy("date", "category").agg(F.sum("cat_count").alias("cat_count"), F.sum("neg_sum").alias("neg_sum"))
    return summed.withColumn("neg_sum", F.col("neg_sum").cast(_SUM))


def _last_load(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("month").agg(F.max("load").alias("load"), F.max_by("sketch", "load").alias("sketch")).select(
        "month", "load", "sketch")


KINDS = {
    "partials": Kind(f"date date, category string, cat_count bigint, neg_sum {_SUM}", "date", _added_up),
    "sketches": Kind("month date, load bigint, sketch binary", "month", _last_load),
}


def index_store(spark: SparkSession, path: str, fan: int = FAN) -> Store:
    return Store(spark, path, KINDS, fan)


def _partials(clean: DataFrame) -> DataFrame:
    exact = clean.withColumn("neg_score", F.col("neg_score").cast("decimal(28,16)"))
    return tension.category_partials(exact).withColumn("neg_sum", F.col("neg_sum").cast(_SUM))


def _doubles(partials: DataFrame) -> DataFrame:
    return partials.withColumn("neg_sum", F.col("neg_sum").cast("double"))


def add_load(clean: DataFrame, store: Store, load: int | None = None, **facts) -> Manifest:
    """Add the articles of a load (date, neg_score, category; see cleaning.clean_news). A load that is added again under its number
    replaces itself if it was the last one; by default it gets the next number."""
    before = store.manifest(before=load)
    load = before.batch + 1 if load is None else load
    tables, name = dict(before.tables), f"load-{load}"
    added = store.write("partials", _partials(clean), name)
    if added:
        months = [r["month"] for r in store.read("partials", [added]).select(F.trunc("date", "month").alias("month")).distinct().collect()]
        tables["partials"] = store.added("partials", before, added)
        stored = store.current("partials", Manifest(load, tables))
        # Literal days reach the scan of the partial sums.
        touched = stored.where(F.col("date").between(min(months), F.last_day(F.lit(max(months)))) & F.trunc("date", "month").isin(months))
        sketches = tension.month_sketches(tension.profile_of_partials(_doubles(touched)))
        tables["sketches"] = store.added("sketches", before, store.write(
            "sketches", sketches.select("month", F.lit(load).cast("bigint").alias("load"), "sketch"), name))
    manifest = Manifest(load, tables, facts)
    store.commit(manifest)
    return manifest


def current_index(store: Store, sketched: bool = False) -> Index:
    """The index of all loads. Percentiles are exact, or from the month sketches if asked for; no article is read."""
    profile = stage(tension.profile_of_partials(_doubles(store.current("partials"))), "daily_profile")
    percentiles = tension.percentiles_of_sketches(store.current("sketches")) if sketched else tension.index_percentiles(profile)
    return Index(tension.normalize_index(profile, percentiles).select(*tension.INDEX_COLUMNS), percentiles)


def ingest_load(news: DataFrame, news_path: str, store: Store, by: str = "article_date") -> int:
    """Add a load of classified articles to the news store and to the index; the number of articles that were new.

    The index is written first and marked as open, then the articles, then the mark goes. A load that died in between
    is recognised by one of its articles: if the news store has it, the load was complete, else the index goes back one load.
    """
    last = store.manifest()
    number = last.batch + 1
    if last.facts.get("open"):
        complete = _holds(store.spark, news_path, by, last.facts["probe"])
        number = last.batch + 1 if complete else last.batch
        if complete:
            store.commit(replace(last, facts={}))
    fresh = news_source.not_stored(news_source.as_store_rows(news), news_path, by)
    probe = fresh.where("record_id IS NOT NULL").select("record_id", F.col(by).cast("string").alias("part")).first()
    add_load(news_source.store_as_clean(fresh), store, number, open=True, probe=list(probe) if probe else None)
    written = news_source.append_to_store(fresh, news_path, by)
    store.commit(replace(store.manifest(), facts={}))
    return written


def _holds(spark: SparkSession, news_path: str, by: str, probe: list | None) -> bool:
    if probe is None or not news_source.store_exists(spark, news_path):
        return False
    record, part = probe
    stored = news_source.scan_news_store(spark, news_path)
    same = F.col(by).isNull() if part is None else F.col(by) == F.lit(part).cast(stored.schema[by].dataType)
    return not stored.where(same & (F.col("record_id") == record)).isEmpty()


def run_ingest_load(
    spark: SparkSession, raw_folder: str, news: str, index: str, first_year: int | None = None,
    last_year: int | None = None, by: str = "article_date",
) -> dict[str, int]:
    """Raw files added to the news store and to the index; the lines read and the articles that were new."""
    found, seen = classified_raw_news(spark, raw_folder, first_year, last_year)
    stored = ingest_load(found, news, index_store(spark, index), by)
    return {"lines": seen.get["lines"], "stored": stored}


def run_tension_of_store(
    spark: SparkSession, index: str, index_out: str, spikes_out: str, percentiles_out: str | None = None,
    sigmas: float = V.SPIKE_SIGMAS, sketched: bool = False,
) -> dict[str, int]:
    """The tables of the tension job from the stored partial sums, without the articles."""
    found = current_index(index_store(spark, index), sketched)
    counts = {"index": tables.write_table(found.daily, index_out)}
    counts["spikes"] = tables.write_table(spike_events(spark.read.parquet(index_out), sigmas), spikes_out)
    if percentiles_out:
        tables.write_table(found.percentiles, percentiles_out)
    return counts
