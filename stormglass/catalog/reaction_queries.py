"""Prices around spikes, portfolio risk, and the current reading."""

from __future__ import annotations

from pyspark.sql import functions as F

from stormglass.catalog.index_queries import index_of, spikes_of
from stormglass.catalog.registry import query, rounded
from stormglass.functions import measures
from stormglass.operators import cleaning, portfolio, reactions
from stormglass.operators.archive import overlay_vix, window_slice, with_bar_width
from stormglass.plans import jobs
from stormglass.session import stage
from stormglass.sources import tables
from stormglass.sources.derived import HOLDINGS_UNKNOWN, Derived

_WINDOWED = """
    SELECT spike_date, round(geo_tension_index, 6) AS geo_tension_index, dominant_category,
      price_date, ticker, close, days_from_spike FROM windowed"""
_BY_SPIKE = """
    SELECT spike_date, dominant_category, ticker, days_from_spike,
      round(avg_return_pct, 6) AS avg_return_pct, num_obs FROM by_spike"""
_SUMMARY = """
    SELECT ticker, round(avg_return_5d, 6) AS avg_return_5d, round(avg_return_30d, 6)
      AS avg_return_30d, round(worst_drawdown, 6) AS worst_drawdown, num_events FROM summary"""
_MEASURES = ("avg_return_5d", "avg_return_30d", "worst_drawdown")


def cells_of(d: Derived):
    return jobs.event_cells(d.prices, spikes_of(d), -30, 30)


def summary_of(d: Derived):
    return reactions.ticker_summary(cells_of(d))


def holdings_of(d: Derived, **options):
    return portfolio.join_portfolio_reactions(d.portfolio(), summary_of(d), **options)


@query("scan_prices_merged", "SELECT date, ticker, close FROM prices "
       "WHERE NOT (year(date) = 1995 AND ticker = (SELECT min(p_brand) FROM part))")
def _(d):
    return tables.scan_long_prices(d.spark, *d.wide_price_folder())


@query("prices_wide_to_long", "SELECT date, ticker, close FROM prices")
def _(d):
    wide = d.prices.groupBy("date").pivot("ticker").agg(F.first("close"))
    nanos = (F.unix_micros(F.col("date").cast("timestamp")) * 1000).alias("Date")
    return reactions.prices_wide_to_long(wide.select(nanos, *wide.drop("date").columns))


@query("scan_parquet", "SELECT date, ticker, close FROM prices")
def _(d):
    return stage(d.prices, "prices")


@query("literal_table", """
    SELECT ticker, weight, count(close) AS prices FROM portfolio_unknown LEFT JOIN prices USING (ticker)
    GROUP BY ALL""")
def _(d):
    counts = d.prices.groupBy("ticker").agg(F.count("*").alias("n"))
    holdings = tables.literal_portfolio(d.spark, HOLDINGS_UNKNOWN).join(counts, "ticker", "left")
    return holdings.select("ticker", "weight", F.coalesce("n", F.lit(0)).alias("prices"))


@query("event_window_join", _WINDOWED)
def _(d):
    return rounded(reactions.window_prices(d.prices, spikes_of(d)), "geo_tension_index")


@query("event_window_join_shuffled", _WINDOWED)
def _(d):
    joined = reactions.window_prices(d.prices, spikes_of(d), broadcast_bytes=0)
    return rounded(joined, "geo_tension_index")


@query("join_day0_base", """
    SELECT spike_date, ticker, days_from_spike, close, close_day0, round(return_pct, 6) AS return_pct
    FROM based""")
def _(d):
    based = reactions.join_day0_base(reactions.window_prices(d.prices, spikes_of(d)))
    columns = ["spike_date", "ticker", "days_from_spike", "close", "close_day0", "return_pct"]
    return rounded(based.select(*columns), "return_pct")


@query("return_pct", """
    SELECT l_orderkey, l_linenumber, round((l_extendedprice - l_quantity) / l_quantity * 100, 4)
      AS return_pct FROM lineitem""")
def _(d):
    change = measures.return_pct(F.col("l_extendedprice"), F.col("l_quantity"))
    rows = d.table("lineitem").select("l_orderkey", "l_linenumber", change.alias("return_pct"))
    return rounded(rows, "return_pct", places=4)


@query("reaction_by_spike", _BY_SPIKE)
def _(d):
    return rounded(reactions.reaction_by_spike(cells_of(d)), "avg_return_pct")


@query("event_window", _BY_SPIKE)
def _(d):
    result = jobs.event_window(d.prices, spikes_of(d))
    return rounded(result.by_spike, "avg_return_pct")


@query("reaction_curve", """
    SELECT ticker, days_from_spike, round(avg_return_pct, 6) AS avg_return_pct, num_events
    FROM curve""")
def _(d):
    return rounded(reactions.reaction_curve(cells_of(d)), "avg_return_pct")


@query("ticker_summary", _SUMMARY)
def _(d):
    return rounded(summary_of(d), *_MEASURES)


# Every price twice, the copy 10 % higher: returns are taken over all pairs with the day-0 prices.
_COPIES = """
    SELECT p.*, s.date AS spike_date, dominant_category,
      CAST(date_diff('day', s.date, p.date) AS INTEGER) AS days_from_spike
    FROM (SELECT date, ticker, close FROM prices UNION ALL
          SELECT date, ticker, close * 1.1 FROM prices) p
      JOIN spikes s ON date_diff('day', s.date, p.date) BETWEEN -30 AND 30"""


@query("reaction_copied_prices", f"""
    SELECT w.spike_date, w.ticker, w.days_from_spike,
      round(avg((w.close - b.close) / b.close * 100), 6) AS avg_return_pct,
      round(min((w.close - b.close) / b.close * 100), 6) AS min_return_pct, count(*) AS num_obs
    FROM ({_COPIES}) w JOIN ({_COPIES}) b ON w.spike_date = b.spike_date AND w.ticker = b.ticker
      AND b.days_from_spike = 0
    GROUP BY ALL""")
def _(d):
    copies = d.prices.unionByName(d.prices.withColumn("close", F.col("close") * 1.1))
    cells = jobs.event_cells(copies, spikes_of(d), -30, 30)
    columns = ["spike_date", "ticker", "days_from_spike", "avg_return_pct", "min_return_pct", "num_obs"]
    return rounded(cells.select(*columns), "avg_return_pct", "min_return_pct")


@query("join_portfolio_reactions", """
    SELECT ticker, weight, round(avg_return_5d, 6) AS avg_return_5d,
      round(avg_return_30d, 6) AS avg_return_30d, round(worst_drawdown, 6) AS worst_drawdown,
      num_events FROM holdings_unknown""")
def _(d):
    joined = portfolio.join_portfolio_reactions(d.portfolio(tuple(HOLDINGS_UNKNOWN)), summary_of(d))
    return rounded(joined, *_MEASURES)


@query("join_portfolio_reactions_zero", """
    SELECT ticker, weight, round(coalesce(avg_return_5d, 0), 6) AS avg_return_5d,
      round(coalesce(worst_drawdown, 0), 6) AS worst_drawdown FROM holdings_unknown""")
def _(d):
    joined = portfolio.join_portfolio_reactions(
        d.portfolio(tuple(HOLDINGS_UNKNOWN)), summary_of(d), missing_as_zero=True
    )
    wanted = joined.select("ticker", "weight", "avg_return_5d", "worst_drawdown")
    return rounded(wanted, "avg_return_5d", "worst_drawdown")


@query("portfolio_risk", """
    SELECT round(sum(weight * avg_return_5d / 100), 6) AS weighted_avg_return_5d,
      round(sum(weight * avg_return_30d / 100), 6) AS weighted_avg_return_30d,
      round(sum(weight * worst_drawdown / 100), 6) AS weighted_worst_drawdown FROM holdings""")
def _(d):
    return rounded(
        portfolio.portfolio_risk(holdings_of(d)), *(f"weighted_{m}" for m in _MEASURES)
    )


@query("exposure_ranking", """
    SELECT ticker, weight, round(avg_return_5d, 6) AS avg_return_5d,
      round(worst_drawdown, 6) AS worst_drawdown, round(exposure_score, 6) AS exposure_score
    FROM exposure ORDER BY exposure.exposure_score DESC NULLS LAST, ticker""")
def _(d):
    ranked = portfolio.exposure_ranking(holdings_of(d))
    return rounded(ranked, "avg_return_5d", "worst_drawdown", "exposure_score")


@query("most_exposed", """
    SELECT ticker, round(exposure_score, 6) AS exposure_score FROM exposure
    ORDER BY exposure.exposure_score DESC NULLS LAST, ticker LIMIT 1""")
def _(d):
    return rounded(portfolio.most_exposed(holdings_of(d)), "exposure_score")


@query("weight_check", """
    SELECT sum(weight) AS total_weight, sum(weight) = 100 AS is_complete
    FROM portfolio SEMI JOIN prices USING (ticker)""")
def _(d):
    traded = d.portfolio().join(d.prices, "ticker", "left_semi")
    return portfolio.weight_check(traded)


@query("day_over_day_change", """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index,
      round(geo_tension_index - lag(geo_tension_index) OVER (ORDER BY date), 6) AS change FROM idx""")
def _(d):
    changes = portfolio.day_over_day_change(stage(index_of(d).daily, "index"))
    return rounded(changes, "geo_tension_index", "change")


@query("last_two_days", """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index FROM idx
    ORDER BY date DESC LIMIT 2""")
def _(d):
    last = portfolio.last_two_days(index_of(d).daily)
    return rounded(last.select("date", "geo_tension_index"), "geo_tension_index")


@query("events_today", "SELECT max(date) AS date, arg_max(total_events, date) AS events_today FROM idx")
def _(d):
    return portfolio.latest_reading(index_of(d).daily).select("date", "events_today")


_STATS = """(SELECT avg(geo_tension_index) AS mean, stddev_samp(geo_tension_index) AS std FROM idx)"""
_LEVEL = """CASE WHEN {x} > mean + 3 * std THEN 'High' WHEN {x} > mean + 1.5 * std THEN 'Medium'
      ELSE 'Low' END"""


@query("global_risk_stats", f"""
    SELECT round(mean, 6) AS mean, round(std, 6) AS std, round(mean + 3 * std, 6) AS high_threshold,
      round(mean + 1.5 * std, 6) AS medium_threshold FROM {_STATS}""")
def _(d):
    stats = portfolio.global_risk_stats(index_of(d).daily)
    return rounded(stats, "mean", "std", "high_threshold", "medium_threshold")


@query("risk_level", f"""
    SELECT date, {_LEVEL.format(x='geo_tension_index')} AS risk_level FROM idx, {_STATS}""")
def _(d):
    index = index_of(d).daily
    levels = portfolio.with_risk_level(index, portfolio.global_risk_stats(index))
    return levels.select("date", "risk_level")


@query("risk_snapshot", f"""
    SELECT date, round(current_score, 6) AS current_score, round(current_score - previous, 6)
      AS delta_score, events_today, {_LEVEL.format(x='current_score')} AS risk_level,
      (SELECT round(sum(weight * coalesce(avg_return_5d, 0) / 100), 6) FROM holdings)
        AS weighted_avg_return_5d,
      (SELECT round(sum(weight * coalesce(worst_drawdown, 0) / 100), 6) FROM holdings)
        AS weighted_worst_drawdown,
      (SELECT ticker FROM exposure ORDER BY exposure_score DESC NULLS LAST, ticker LIMIT 1)
        AS most_exposed
    FROM (SELECT max(date) AS date, arg_max(geo_tension_index, date) AS current_score,
            arg_max(total_events, date) AS events_today FROM idx),
      (SELECT geo_tension_index AS previous FROM idx ORDER BY date DESC LIMIT 1 OFFSET 1), {_STATS}""")
def _(d):
    index = stage(index_of(d).daily, "index")
    spikes = stage(jobs.spike_events(index), "spikes")
    summary = stage(jobs.event_window(d.prices, spikes).summary, "summary")
    return rounded(
        jobs.risk_snapshot(index, summary, d.portfolio()), "current_score", "delta_score",
        "weighted_avg_return_5d", "weighted_worst_drawdown",
    )


@query("overlay_vix", """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index, round(vix, 6) AS vix
    FROM idx LEFT JOIN vix USING (date)""")
def _(d):
    return rounded(overlay_vix(index_of(d).daily, d.vix), "geo_tension_index", "vix")


@query("window_slice", """
    SELECT s.date AS spike_date, i.date, CAST(date_diff('day', s.date, i.date) AS INTEGER)
      AS days_from_spike, round(i.geo_tension_index, 6) AS geo_tension_index, round(vix, 6) AS vix
    FROM idx i JOIN spikes s ON abs(date_diff('day', s.date, i.date)) <= 5
      LEFT JOIN vix v ON v.date = i.date""")
def _(d):
    index = stage(index_of(d).daily, "index")
    spikes = stage(jobs.spike_events(index), "spikes")
    sliced = window_slice(overlay_vix(index, d.vix), spikes)
    return rounded(sliced, "geo_tension_index", "vix")


@query("recent_slice", """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index FROM idx
    WHERE date >= (SELECT max(date) FROM idx) - INTERVAL 1825 DAY""")
def _(d):
    index = stage(index_of(d).daily.select("date", "geo_tension_index"), "index")
    last = index.agg(F.max("date").alias("d")).scalar()
    return rounded(cleaning.recent_slice(index, last, 365 * 5), "geo_tension_index")


@query("bar_scale", """
    SELECT ticker, round(avg_return_5d, 6) AS avg_return_5d,
      CAST(coalesce(floor(abs(avg_return_5d) / nullif(max(abs(avg_return_5d)) OVER (), 0) * 180), 0)
        AS INTEGER) AS bar_width FROM summary""")
def _(d):
    bars = with_bar_width(stage(summary_of(d), "summary"), "avg_return_5d", [])
    return rounded(bars.select("ticker", "avg_return_5d", "bar_width"), "avg_return_5d")
