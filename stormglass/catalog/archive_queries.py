"""Supporting news of spikes, labels, the event view, and live news."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.catalog import relations as R
from stormglass.catalog.index_queries import index_of, spikes_of
from stormglass.catalog.reaction_queries import cells_of
from stormglass.catalog.registry import query, rounded
from stormglass.functions import calendar
from stormglass.operators import archive, reactions
from stormglass.operators.cleaning import same_day
from stormglass.operators.windows import nearest_date
from stormglass.plans import jobs
from stormglass.session import scratch_path, stage
from stormglass.sources import news as news_source
from stormglass.sources import tables
from stormglass.sources.derived import Derived
from stormglass.streaming import live

NEWS_COLUMNS = (
    "spike_date, dominant_category, article_date, domain, url, themes, days_from_spike, title"
)


def _minute(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def archive_of(d: Derived, spikes):
    return stage(jobs.spike_news(d.as_articles(), spikes), "spike_news")


@query("news_window_join", """
    SELECT spike_date, dominant_category, article_date, domain, url, themes, days_from_spike
    FROM news_joined""")
def _(d):
    return archive.news_window_join(d.as_articles(), spikes_of(d))


@query("news_window_join_shuffled", """
    SELECT spike_date, dominant_category, article_date, domain, url, themes, days_from_spike
    FROM news_joined""")
def _(d):
    return archive.news_window_join(d.as_articles(), spikes_of(d), broadcast_bytes=0)


@query("spike_news", f"SELECT {NEWS_COLUMNS} FROM spike_news")
def _(d):
    return jobs.spike_news(d.as_articles(), spikes_of(d))


@query("spike_news_from_store", f"SELECT {NEWS_COLUMNS} FROM spike_news")
def _(d):
    path = scratch_path(d.spark, "news_store")
    news_source.write_news_store(d.news, path, by="article_month")
    store = news_source.scan_news_store(d.spark, path)
    index = jobs.tension_index(news_source.store_as_clean(store)).daily
    spikes = stage(jobs.spike_events(index), "spikes")
    return jobs.spike_news(news_source.store_as_articles(store), spikes)


@query("top_news_per_spike", f"""
    SELECT {NEWS_COLUMNS} FROM titled QUALIFY row_number() OVER (
      PARTITION BY spike_date ORDER BY days_from_spike, url, domain, themes) <= 5""")
def _(d):
    return jobs.spike_news(d.as_articles(), spikes_of(d), n=5)


@query("top_news_closest_first", f"""
    SELECT {NEWS_COLUMNS} FROM titled QUALIFY row_number() OVER (
      PARTITION BY spike_date ORDER BY abs(days_from_spike), days_from_spike, url, domain, themes) <= 5""")
def _(d):
    return jobs.spike_news(d.as_articles(), spikes_of(d), n=5, closest_first=True)


@query("news_around_label_date", """
    SELECT event_date, spike_date, article_date, url, title, days_from_event FROM around""")
def _(d):
    spikes = spikes_of(d)
    around = archive.news_around_date(archive_of(d, spikes), spikes)
    return around.select("event_date", "spike_date", "article_date", "url", "title", "days_from_event")


@query("keyword_counts", "SELECT event_date, word, n FROM word_counts")
def _(d):
    spikes = spikes_of(d)
    return archive.keyword_counts(archive.news_around_date(archive_of(d, spikes), spikes))


@query("auto_labels", "SELECT date, auto_label FROM auto_labels")
def _(d):
    spikes = spikes_of(d)
    around = archive.news_around_date(archive_of(d, spikes), spikes)
    return archive.auto_labels(archive.keyword_counts(around))


@query("auto_labels_from_sketches", "SELECT date, auto_label FROM auto_labels")
def _(d):
    spikes = spikes_of(d)
    around = stage(archive.news_around_date(archive_of(d, spikes), spikes), "around")
    return archive.auto_labels(archive.frequent_word_counts(around))


@query("join_labels", """
    SELECT date, coalesce(label, 'Geopolitical Event') AS label
    FROM spikes LEFT JOIN labels USING (date)""")
def _(d):
    spikes = spikes_of(d)
    return archive.join_labels(spikes, d.labels(spikes)).select("date", "label")


@query("spike_labels", """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index, label FROM labelled
    ORDER BY labelled.geo_tension_index DESC, date""")
def _(d):
    spikes = spikes_of(d)
    labelled = archive.spike_labels(spikes, d.labels(spikes), archive_of(d, spikes))
    ordered = labelled.orderBy(F.col("geo_tension_index").desc(), "date")
    return rounded(ordered.select("date", "geo_tension_index", "label"), "geo_tension_index")


@query("spike_options", """
    SELECT date, strftime(date, '%Y-%m-%d') || ' | ' || label AS option FROM labelled
    ORDER BY date DESC""")
def _(d):
    spikes = spikes_of(d)
    return archive.spike_options(archive.spike_labels(spikes, d.labels(spikes), archive_of(d, spikes)))


@query("supporting_news", f"""
    SELECT event_date, label, article_date, spike_date, domain, url, title FROM (
      SELECT around.*, label FROM around JOIN labelled ON event_date = labelled.date)
    WHERE {R.ARCHIVE_TITLE_OK} AND {R.relevant('title', 'label')}
    QUALIFY row_number() OVER (
      PARTITION BY event_date ORDER BY article_date, spike_date, url, domain) <= 6""")
def _(d):
    spikes = spikes_of(d)
    news = archive_of(d, spikes)
    labelled = stage(archive.spike_labels(spikes, d.labels(spikes), news), "labelled")
    return archive.supporting_news(news, labelled)


@query("join_sector", """
    SELECT date, ticker, close, sector FROM prices JOIN sectors USING (ticker)""")
def _(d):
    return archive.join_sector(d.prices, d.sectors).select("date", "ticker", "close", "sector")


@query("filter_mapped_sector", """
    SELECT sector, count(*) AS n FROM prices JOIN sectors USING (ticker) GROUP BY sector""")
def _(d):
    return archive.join_sector(d.prices, d.sectors).groupBy("sector").agg(F.count("*").alias("n"))


@query("nearest_spike_match", "SELECT date, nearest_date FROM matched")
def _(d):
    spikes = spikes_of(d)
    cells = jobs.event_cells(d.prices, spikes, -30, 30)
    return archive.nearest_spike_match(spikes, reactions.reaction_by_spike(cells))


@query("nearest_ship_day", """
    SELECT date, arg_min(have, abs(date_diff('day', date, have)) * 2
        + CASE WHEN have > date THEN 1 ELSE 0 END) AS nearest_date
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
      CROSS JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS have FROM lineitem)
    GROUP BY date""")
def _(d):
    wanted = d.table("orders").select(F.col("o_orderdate").cast("date").alias("date"))
    shipped = d.table("lineitem").select(F.col("l_shipdate").cast("date").alias("date"))
    return nearest_date(wanted, shipped)


@query("target_offset", """
    SELECT spike_date, CAST(target_offset AS INTEGER) AS target_offset FROM offsets""")
def _(d):
    by_spike = reactions.reaction_by_spike(cells_of(d))
    return archive.target_offset(archive.join_sector(by_spike, d.sectors))


@query("sector_reaction", """
    SELECT spike_date, CAST(target_offset AS INTEGER) AS target_offset, sector,
      round(avg_return_pct, 6) AS avg_return_pct FROM by_sector""")
def _(d):
    by_spike = stage(reactions.reaction_by_spike(cells_of(d)), "by_spike")
    return rounded(archive.sector_reaction(by_spike, d.sectors), "avg_return_pct")


@query("event_explorer", """
    SELECT date, nearest_date, CAST(target_offset AS INTEGER) AS target_offset, sector,
      round(avg_return_pct, 6) AS avg_return_pct
    FROM matched JOIN by_sector ON nearest_date = spike_date""")
def _(d):
    spikes = spikes_of(d)
    by_spike = jobs.event_window(d.prices, spikes).by_spike
    return rounded(archive.sector_impact(spikes, by_spike, d.sectors), "avg_return_pct")


@query("event_view", f"""
    SELECT 'chart' AS part, s.date AS event_date, strftime(i.date, '%Y-%m-%d') AS name,
      round(i.geo_tension_index, 6) AS value, round(vix, 6) AS other
    FROM idx i JOIN spikes s ON abs(date_diff('day', s.date, i.date)) <= 5 LEFT JOIN vix v ON v.date = i.date
    UNION ALL SELECT 'sectors', date, sector, round(avg_return_pct, 6), target_offset::DOUBLE
    FROM matched JOIN by_sector ON nearest_date = spike_date
    UNION ALL SELECT 'news', event_date, url, NULL, NULL FROM (
      SELECT around.*, label FROM around JOIN labelled ON event_date = labelled.date)
    WHERE {R.ARCHIVE_TITLE_OK} AND {R.relevant('title', 'label')}
    QUALIFY row_number() OVER (
      PARTITION BY event_date ORDER BY article_date, spike_date, url, domain) <= 6""")
def _(d):
    index = stage(index_of(d).daily, "index")
    spikes = stage(jobs.spike_events(index), "spikes")
    by_spike = jobs.event_window(d.prices, spikes).by_spike
    view = jobs.event_view(index, d.vix, spikes, by_spike, d.sectors, d.labels(spikes), archive_of(d, spikes))
    none = F.lit(None).cast("double")
    parts = [
        view.chart.select(F.lit("chart").alias("part"), F.col("spike_date").alias("event_date"),
                          F.date_format("date", "yyyy-MM-dd").alias("name"), F.col("geo_tension_index").alias("value"),
                          F.col("vix").alias("other")),
        view.sectors.select(F.lit("sectors"), "date", "sector", "avg_return_pct", F.col("target_offset").cast("double")),
        view.news.select(F.lit("news"), "event_date", "url", none, none),
    ]
    return rounded(parts[0].union(parts[1]).union(parts[2]), "value", "other")


@query("sector_bars", """
    SELECT spike_date, sector, CAST(coalesce(floor(abs(avg_return_pct)
        / nullif(max(abs(avg_return_pct)) OVER (PARTITION BY spike_date), 0) * 180), 0) AS INTEGER)
      AS bar_width FROM by_sector""")
def _(d):
    by_spike = stage(reactions.reaction_by_spike(cells_of(d)), "by_spike")
    by_sector = stage(archive.sector_reaction(by_spike, d.sectors), "by_sector")
    bars = archive.with_bar_width(by_sector, "avg_return_pct", ["spike_date"])
    return bars.select("spike_date", "sector", "bar_width")


# --- Intraday and live


@query("intraday_return", """
    SELECT event_type AS etf, coalesce(CASE WHEN count(*) >= 2 THEN
        (arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)))
        / nullif(arg_min(value, (ts, event_id)), 0) * 100 END, 0) AS return_pct
    FROM events GROUP BY event_type""")
def _(d):
    funds = d.table("events").withColumnRenamed("event_type", "etf")
    return archive.intraday_return(funds, "etf", "ts", "value", tie="event_id")


@query("sector_fund_returns", """
    SELECT sector, coalesce(return_pct, 0) AS avg FROM (VALUES ('Airlines', 'click'),
        ('Semiconductors', 'view'), ('Energy', 'purchase'), ('Defense', 'signup'), ('Tech', 'error'),
        ('Gold/Safe Haven', 'none')) f(sector, etf)
      LEFT JOIN (SELECT event_type AS etf,
          (arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)))
          / nullif(arg_min(value, (ts, event_id)), 0) * 100 AS return_pct
        FROM events GROUP BY event_type) USING (etf)""")
def _(d):
    names = ["click", "view", "purchase", "signup", "error", "none"]
    funds = tables.sector_funds(d.spark, dict(zip(V.SECTOR_FUNDS, names, strict=True)))
    prices = d.table("events").withColumnRenamed("event_type", "etf")
    returns = archive.intraday_return(prices, "etf", "ts", "value", tie="event_id")
    return archive.sector_fund_returns(funds, returns)


@query("market_open", """
    SELECT event_id, isodow(t) <= 5 AND hour(t) * 60 + minute(t) BETWEEN 570 AND 959 AS market_open
    FROM (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS t FROM events)""")
def _(d):
    rows = d.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return archive.with_market_state(rows, "ts").select("event_id", "market_open")


@query("format_time", """
    SELECT event_id, strftime(ts, '%H:%M UTC') AS clock, strftime(ts, '%Y-%m-%d') AS day
    FROM events""")
def _(d):
    return d.table("events").select(
        "event_id", calendar.clock(F.col("ts")).alias("clock"), calendar.day_text(F.col("ts")).alias("day"),
    )


_LIVE = "strftime(time, '%Y-%m-%d %H:%M:%S') AS time, title, source, category"


@query("live_articles", f"SELECT {_LIVE} FROM live_articles")
def _(d):
    return archive.live_articles(live.drop_repeated(d.live)).select(_minute("time"), "title", "source", "category")


@query("latest_news", f"""
    SELECT {_LIVE} FROM live_articles ORDER BY live_articles.time DESC, title, source, category
    LIMIT 10""")
def _(d):
    newest = archive.latest_news(archive.live_articles(live.drop_repeated(d.live)))
    return newest.select(_minute("time"), "title", "source", "category")


@query("feed_items", f"""
    SELECT title, source, category, strftime(time, '%H:%M UTC') AS clock FROM (
      SELECT * FROM live_articles ORDER BY time DESC, title, source, category LIMIT 10)
    WHERE {R.FEED_TITLE_OK} ORDER BY time DESC, title, source LIMIT 6""")
def _(d):
    shown = archive.feed_items(archive.latest_news(archive.live_articles(live.drop_repeated(d.live))))
    return shown.select("title", "source", "category", "clock")


def _stream_run(d: Derived) -> str:
    """All live files through the stream, few in a batch; where its tables are."""
    folder = scratch_path(d.spark, "stream")
    tables.write_table(index_of(d).percentiles, f"{folder}/percentiles")
    live.start(d.spark, d.live_folder(), f"{folder}/percentiles", f"{folder}/tables", f"{folder}/checkpoint",
               once=True, files_per_batch=3).awaitTermination()
    return f"{folder}/tables"


@query("stream_live_news", f"SELECT {_LIVE} FROM live_articles")
def _(d):
    return live.current_articles(d.spark, _stream_run(d)).select(_minute("time"), "title", "source", "category")


@query("stream_dedup", "SELECT url, tone, count(*) AS n FROM live_once "
       "WHERE try_strptime(date, '%Y%m%d%H%M%S') IS NOT NULL GROUP BY url, tone")
def _(d):
    return live.current_rows(d.spark, _stream_run(d)).groupBy("url", "tone").agg(F.count("*").alias("n"))


_BAD_LINES = """(SELECT 'too many fields' AS reason FROM live_raw WHERE date LIKE '20240102%'
      UNION ALL SELECT 'no valid time' FROM live_raw WHERE try_strptime(date, '%Y%m%d%H%M%S') IS NULL)"""
_ALL_LINES = "(SELECT count(*) + count(*) FILTER (WHERE date LIKE '20240101%' OR date LIKE '20240102%') AS n FROM live_raw)"


@query("stream_quarantine", f"""
    SELECT reason, count(*) AS lines FROM {_BAD_LINES} GROUP BY reason
    UNION ALL SELECT 'read', n FROM {_ALL_LINES}
    UNION ALL SELECT 'kept', n - (SELECT count(*) FROM {_BAD_LINES}) FROM {_ALL_LINES}""")
def _(d):
    out = _stream_run(d)
    found = live.quarantined(d.spark, out).groupBy("reason").agg(F.count("*").alias("lines"))
    counts = live.line_counts(d.spark, out)
    return found.unionByName(d.spark.createDataFrame(
        [("read", counts["lines"]), ("kept", counts["kept"])], "reason string, lines bigint"))


@query("stream_latest_news", f"""
    SELECT {_LIVE} FROM live_articles ORDER BY live_articles.time DESC, title, source, category
    LIMIT 10""")
def _(d):
    newest = live.current_latest(d.spark, _stream_run(d))
    return newest.select(_minute("time"), "title", "source", "category")


_READINGS = """
    SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, total_events,
      round(tension_score, 6) AS tension_score FROM readings"""


def _percentiles(d: Derived):
    low, high = index_of(d).percentiles.first()
    return F.lit(low), F.lit(high)


@query("tension_readings", _READINGS)
def _(d):
    readings = live.tension_readings(d.live, *_percentiles(d))
    return rounded(readings.select(_minute("timestamp"), "total_events", "tension_score"), "tension_score")


@query("stream_tension_readings", _READINGS)
def _(d):
    now = live.current_readings(d.spark, _stream_run(d))
    return rounded(now.select(_minute("timestamp"), "total_events", "tension_score"), "tension_score")


@query("readings_today", f"""
    {_READINGS} WHERE readings.timestamp >= (SELECT date_trunc('day', max(timestamp)) FROM readings)
    ORDER BY readings.timestamp""")
def _(d):
    readings = stage(live.tension_readings(d.live, *_percentiles(d)), "readings")
    last = readings.agg(F.max("timestamp").alias("t")).scalar()
    today = same_day(readings, last).orderBy("timestamp")
    return rounded(today.select(_minute("timestamp"), "total_events", "tension_score"), "tension_score")


@query("live_feed", f"""
    SELECT time, title, source, category, tension_score FROM (
      SELECT {_LIVE}, time_bucket(INTERVAL 15 MINUTE, live_articles.time) AS slot FROM live_articles
      ORDER BY live_articles.time DESC, title, source, category LIMIT 10) f
    LEFT JOIN (SELECT timestamp AS slot, round(tension_score, 6) AS tension_score FROM readings)
      USING (slot)""")
def _(d):
    newest = archive.latest_news(archive.live_articles(live.drop_repeated(d.live)))
    slotted = newest.withColumn("timestamp", F.window("time", live.READING)["start"])
    readings = live.tension_readings(d.live, *_percentiles(d)).select("timestamp", "tension_score")
    joined = slotted.join(readings, "timestamp", "left")
    columns = [_minute("time"), "title", "source", "category", "tension_score"]
    return rounded(joined.select(*columns), "tension_score")


#: Days that bring the order dates to the years of the known events.
_TO_KNOWN = 9131
_KNOWN = ", ".join(f"(DATE '{day}', '{label}')" for day, label in V.KNOWN_EVENTS.items())


@query("known_events", f"""
    SELECT label, count(*) AS orders FROM (SELECT CAST(o_orderdate AS DATE) + {_TO_KNOWN} AS date FROM orders)
    JOIN (VALUES {_KNOWN}) k(date, label) USING (date) GROUP BY label""")
def _(d):
    orders = d.table("orders").select(F.date_add(F.col("o_orderdate").cast("date"), _TO_KNOWN).alias("date"))
    return orders.join(tables.known_events(d.spark), "date").groupBy("label").agg(F.count("*").alias("orders"))


_CHART_TIME = "strftime(CAST({} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS time"


def _live_chart(d: Derived, now: str):
    index = index_of(d)
    low, high = index.percentiles.first()
    readings = live.tension_readings(d.live, F.lit(low), F.lit(high))
    views = d.table("events").filter("event_type = 'view'")
    vix_minutes = views.select(F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("vix"))
    chart = jobs.live_chart(datetime.fromisoformat(now), readings, vix_minutes, index.daily, d.vix)
    return rounded(chart.select("series", _minute("time"), "value"), "value")


@query("live_chart_market_open", f"""
    SELECT 'tension' AS series, {_CHART_TIME.format('timestamp')}, round(tension_score, 6) AS value
    FROM readings WHERE timestamp >= DATE '2024-01-30'
    UNION ALL SELECT 'vix', {_CHART_TIME.format('ts')}, round(value, 6) FROM events
    WHERE event_type = 'view' AND ts >= DATE '2024-01-30'""")
def _(d):
    return _live_chart(d, "2024-01-30 15:00:00")


@query("live_chart_market_closed", f"""
    SELECT 'tension' AS series, {_CHART_TIME.format('date')}, round(geo_tension_index, 6) AS value
    FROM idx WHERE date >= TIMESTAMP '2001-07-25 23:00:00'
    UNION ALL SELECT 'vix', {_CHART_TIME.format('date')}, round(vix, 6) FROM vix
    WHERE date >= TIMESTAMP '2001-07-25 23:00:00'""")
def _(d):
    return _live_chart(d, "2001-07-30 23:00:00")
