"""The jobs users run. Each takes DataFrames or paths, and stages what is small and shared."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.operators import archive, cleaning, portfolio, reactions, tension, themes
from stormglass.operators.windows import measure
from stormglass.session import stage
from stormglass.sources import news as news_source
from stormglass.sources import tables
from stormglass.streaming import live


@dataclass(frozen=True)
class Index:
    """Daily index and what it was scaled with (the live score needs the same percentiles)."""

    daily: DataFrame
    percentiles: DataFrame


def tension_index(clean: DataFrame, accuracy: int | None = None) -> Index:
    """One scan of the articles; everything after it works on the staged daily table.

    The percentiles are exact, or approximate with an accuracy (a rank is off by at most days / accuracy).
    """
    profile = stage(tension.daily_profile(clean), "daily_profile")
    percentiles = tension.index_percentiles(profile, accuracy)
    daily = tension.normalize_index(profile, percentiles).select(*tension.INDEX_COLUMNS)
    return Index(daily, percentiles)


def spike_events(index: DataFrame, sigmas: float = V.SPIKE_SIGMAS) -> DataFrame:
    return tension.spike_events(index, sigmas)


def event_cells(prices: DataFrame, spikes: DataFrame, low: int, high: int) -> DataFrame:
    """Returns around spikes per spike, ticker and offset."""
    return reactions.reaction_cells(reactions.window_prices(prices, spikes, low, high))


@dataclass(frozen=True)
class Reactions:
    by_spike: DataFrame
    curve: DataFrame
    summary: DataFrame


def event_window(
    prices: DataFrame, spikes: DataFrame, low: int = V.PRICE_WINDOW[0], high: int = V.PRICE_WINDOW[1]
) -> Reactions:
    """Three views of one staged table; prices are read once. Spikes should be a stored table."""
    cells = stage(event_cells(prices, spikes, low, high), "reaction_cells")
    return Reactions(
        reactions.reaction_by_spike(cells),
        reactions.reaction_curve(cells),
        reactions.ticker_summary(cells),
    )


def spike_news(
    articles: DataFrame, spikes: DataFrame, n: int = V.NEWS_PER_SPIKE, closest_first: bool = False
) -> DataFrame:
    titled = archive.add_titles(archive.news_window_join(articles, spikes))
    return archive.top_news_per_spike(titled, n, closest_first).select(*archive.NEWS_COLUMNS)


@dataclass(frozen=True)
class EventView:
    """What the page of an event shows: index and volatility around it, sector impact, supporting news."""

    chart: DataFrame
    sectors: DataFrame
    news: DataFrame


def event_view(
    index: DataFrame, vix: DataFrame, spikes: DataFrame, by_spike: DataFrame, sectors: DataFrame,
    known: DataFrame, spike_news: DataFrame, day: date | None = None,
) -> EventView:
    """The view of all spikes, or of the one on a day. Inputs should be stored tables."""
    labelled = stage(archive.spike_labels(spikes, known, spike_news), "labelled")
    if day is not None:
        labelled = labelled.filter(F.col("date") == F.lit(day))
    return EventView(
        archive.window_slice(archive.overlay_vix(index, vix), labelled),
        archive.sector_impact(labelled, by_spike, sectors),
        archive.supporting_news(spike_news, labelled),
    )


def risk_snapshot(index: DataFrame, summary: DataFrame, holdings: DataFrame) -> DataFrame:
    """Current score, risk level and portfolio figures in one row. Inputs should be stored tables."""
    joined = portfolio.join_portfolio_reactions(holdings, summary, missing_as_zero=True)
    return portfolio.risk_snapshot(index, joined)


def live_chart(
    now: datetime, readings: DataFrame, vix_minutes: DataFrame, index: DataFrame, vix: DataFrame
) -> DataFrame:
    """Points of the live chart at a time (UTC)."""
    return archive.live_chart(F.lit(f"{now:%Y-%m-%d %H:%M:%S}").cast("timestamp"), readings, vix_minutes, index, vix)


# --- Jobs on paths


def run_ingest(
    spark: SparkSession, raw_folder: str, out: str, first_year: int | None = None,
    last_year: int | None = None, by: str = "article_date", update: bool = False,
) -> dict[str, int]:
    """Raw archive to the classified news store, partitioned by day or month. All files below the folder are read,
    or those of some years; an update adds to the store. Returns the lines read and the articles stored."""
    news, seen = classified_raw_news(spark, raw_folder, first_year, last_year)
    stored = news_source.write_news_store(news, out, by, update)
    return {"lines": seen.get["lines"], "stored": stored}


def classified_raw_news(
    spark: SparkSession, raw_folder: str, first_year: int | None = None, last_year: int | None = None
) -> tuple[DataFrame, Observation]:
    """Classified articles of raw files, by a dictionary of theme codes, and an observation that counts the lines read."""
    raw = news_source.scan_raw_news(spark, raw_folder, first_year=first_year, last_year=last_year)
    dictionary, seen = themes.learn(raw, themes.BATCH), Observation()
    return news_source.ingest_raw_news(raw.observe(seen, F.count("*").alias("lines")), dictionary), seen


_TEXT_SUFFIXES = (".tsv", ".tsv.gz", ".txt", ".csv")


def _clean_input(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(_TEXT_SUFFIXES):
        return cleaning.clean_news(news_source.scan_news_tsv(spark, path))
    return news_source.store_as_clean(news_source.scan_news_store(spark, path))


def _article_input(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(_TEXT_SUFFIXES):
        return news_source.scan_news_positional(spark, path)
    return news_source.store_as_articles(news_source.scan_news_store(spark, path))


def run_tension(
    spark: SparkSession, news: str, index_out: str, spikes_out: str, percentiles_out: str | None = None,
    sigmas: float = V.SPIKE_SIGMAS, accuracy: int | None = None,
) -> dict[str, int]:
    index = tension_index(_clean_input(spark, news), accuracy)
    counts = {"index": tables.write_table(index.daily, index_out)}
    stored = spark.read.parquet(index_out)
    counts["spikes"] = tables.write_table(spike_events(stored, sigmas), spikes_out)
    if percentiles_out:
        tables.write_table(index.percentiles, percentiles_out)
    return counts


def run_event_window(
    spark: SparkSession, price_paths: list[str], spikes: str, by_spike_out: str, curve_out: str,
    summary_out: str,
) -> None:
    stored = spark.read.parquet(spikes)
    low, high = V.PRICE_WINDOW
    extent = measure(stored.select("date"), "date")
    days = {}
    if extent.first is not None:
        days = {"first": extent.first + timedelta(days=low), "last": extent.last + timedelta(days=high)}
    result = event_window(tables.scan_long_prices(spark, *price_paths, **days), stored)
    tables.write_sorted(result.by_spike, by_spike_out, "spike_date", "ticker", "days_from_spike")
    tables.write_sorted(result.curve, curve_out, "ticker", "days_from_spike")
    tables.write_table(result.summary, summary_out)


def run_portfolio(
    spark: SparkSession, summary: str, risk_out: str, exposure_out: str,
    holdings: DataFrame | None = None,
) -> None:
    holdings = holdings if holdings is not None else tables.literal_portfolio(spark)
    joined = portfolio.join_portfolio_reactions(holdings, spark.read.parquet(summary))
    tables.write_table(portfolio.portfolio_risk(joined), risk_out)
    tables.write_table(portfolio.exposure_ranking(joined), exposure_out)


def run_spike_news(
    spark: SparkSession, news: str, spikes: str, out: str, n: int = V.NEWS_PER_SPIKE
) -> int:
    found = spike_news(_article_input(spark, news), spark.read.parquet(spikes), n)
    return tables.write_table(found, out)


def run_event_view(
    spark: SparkSession, index: str, vix: str, spikes: str, by_spike: str, spike_news: str, out: str,
    day: date | None = None,
) -> dict[str, int]:
    read = spark.read.parquet
    view = event_view(
        read(index), read(vix), read(spikes), read(by_spike), tables.sector_tickers(spark), tables.known_events(spark),
        read(spike_news), day)
    parts = {"chart": view.chart, "sectors": view.sectors, "news": view.news}
    return {name: tables.write_table(part, f"{out}/{name}") for name, part in parts.items()}


def run_risk_snapshot(
    spark: SparkSession, index: str, summary: str, out: str, holdings: DataFrame | None = None
) -> int:
    holdings = holdings if holdings is not None else tables.literal_portfolio(spark)
    return tables.write_table(risk_snapshot(spark.read.parquet(index), spark.read.parquet(summary), holdings), out)


def run_live_chart(
    spark: SparkSession, live_tables: str, vix_minutes: str, index: str, vix: str, out: str, now: datetime | None = None
) -> int:
    """The chart from the tables of the live job, daily index and volatility; now is the current time by default."""
    read = spark.read.parquet
    points = live_chart(now or datetime.now(UTC), live.current_readings(spark, live_tables), read(vix_minutes),
                        read(index), read(vix))
    return tables.write_table(points, out)
