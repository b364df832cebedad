"""News sources and sinks, cleaning, and the tension index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.catalog import relations as R
from stormglass.catalog.registry import query, rounded
from stormglass.functions import calendar, news_text
from stormglass.operators import cleaning, tension, themes
from stormglass.plans import index_store, jobs
from stormglass.session import scratch_path, stage
from stormglass.sources import news as news_source
from stormglass.sources import tables
from stormglass.sources.derived import Derived, pick

NEWS = "record_id, date, source, url, themes, tone, category"


def index_of(d: Derived) -> jobs.Index:
    return jobs.tension_index(cleaning.clean_news(d.news))


def spikes_of(d: Derived) -> DataFrame:
    return stage(jobs.spike_events(index_of(d).daily), "spikes")


# --- Sources and sinks


@query("scan_news_tsv", f"SELECT {NEWS} FROM news")
def _(d):
    return news_source.scan_news_tsv(d.spark, d.news_file())


@query("scan_news_positional",
       "SELECT datetime, domain, url, themes, category, article_date FROM articles")
def _(d):
    return news_source.scan_news_positional(d.spark, d.news_file())


@query("ingest_raw_news", f"SELECT {NEWS} FROM news")
def _(d):
    return news_source.ingest_raw_news(news_source.scan_raw_news(d.spark, d.raw_news_folder()))


@query("ingest", f"""
    SELECT {NEWS}, TRY_CAST(str_split(tone, ',')[3] AS DOUBLE) AS neg_score,
      regexp_matches(themes, '#(U[A-RT-Z]|[A-TV-Z][A-Z])#') AS is_foreign,
      CASE WHEN length(date) >= 8 THEN CAST(try_strptime(substr(date, 1, 8), '%Y%m%d') AS DATE) END
        AS article_date,
      CASE WHEN length(date) >= 8 THEN
        strftime(try_strptime(substr(date, 1, 8), '%Y%m%d'), '%Y-%m') END AS article_month
    FROM news""")
def _(d):
    store = scratch_path(d.spark, "news_store")
    raw = news_source.scan_raw_news(d.spark, d.raw_news_folder())
    news_source.write_news_store(news_source.ingest_raw_news(raw), store, by="article_month")
    return news_source.scan_news_store(d.spark, store)


_STORE = f"""
    SELECT {NEWS}, TRY_CAST(str_split(tone, ',')[3] AS DOUBLE) AS neg_score,
      regexp_matches(themes, '#(U[A-RT-Z]|[A-TV-Z][A-Z])#') AS is_foreign,
      CASE WHEN length(date) >= 8 THEN CAST(try_strptime(substr(date, 1, 8), '%Y%m%d') AS DATE) END
        AS article_date,
      CASE WHEN length(date) >= 8 THEN
        strftime(try_strptime(substr(date, 1, 8), '%Y%m%d'), '%Y-%m') END AS article_month
    FROM news"""


@query("ingest_by_day", _STORE)
def _(d):
    store = scratch_path(d.spark, "news_store")
    raw = news_source.scan_raw_news(d.spark, d.raw_news_folder())
    news_source.write_news_store(news_source.ingest_raw_news(raw), store)
    return news_source.scan_news_store(d.spark, store)


@query("ingest_update", _STORE)
def _(d):
    """Three loads into the same months, bad dates in each, some records in two of them."""
    store = scratch_path(d.spark, "news_store")
    news = d.news
    part = F.col("record_id").cast("bigint") % 3
    for load in (part < 2, part > 0, part == 2):
        news_source.write_news_store(news.where(load), store, by="article_month", update=True)
    return news_source.scan_news_store(d.spark, store)


@query("prune_files_by_year", """
    SELECT path FROM (SELECT 'http://archive.example/v2/' || strftime(o_orderdate, '%Y%m%d')
        || '120000' || ['.gkg.csv.zip', '.export.CSV.zip', '.mentions.CSV.zip'][o_orderkey % 3 + 1]
        AS path FROM orders)
    WHERE contains(path, '.gkg.csv') AND regexp_matches(path, '/(1996|1997|1998)')""")
def _(d):
    return news_source.prune_files_by_year(d.file_listing(), 1996, 1998)


@query("sink_parquet_overwrite",
       "SELECT date, round(geo_tension_index, 6) AS geo_tension_index, total_events, "
       "dominant_category FROM idx")
def _(d):
    path = scratch_path(d.spark, "index")
    index = rounded(index_of(d).daily, "geo_tension_index")
    tables.write_table(index.limit(1), path)
    tables.write_table(index, path)
    return d.spark.read.parquet(path)


@query("sink_append",
       f"SELECT {NEWS} FROM news WHERE category = 'CONFLICT' UNION ALL "
       f"SELECT {NEWS} FROM news WHERE category <> 'CONFLICT'")
def _(d):
    path = scratch_path(d.spark, "appended")
    tables.append_table(d.news.filter("category = 'CONFLICT'"), path)
    tables.append_table(d.news.filter("category <> 'CONFLICT'"), path)
    return d.spark.read.parquet(path)


@query("row_count_report", "SELECT 'news' AS output, count(*) AS row_count FROM news")
def _(d):
    rows = tables.write_table(d.news, scratch_path(d.spark, "counted"))
    return d.spark.createDataFrame([("news", rows)], "output string, row_count bigint")


# --- Cleaning


@query("parse_news_date", "SELECT record_id, date FROM dated")
def _(d):
    return cleaning.parse_news_date(d.news).select("record_id", "date")


@query("filter_international",
       "SELECT record_id, themes FROM news "
       "WHERE regexp_matches(themes, '#(U[A-RT-Z]|[A-TV-Z][A-Z])#')")
def _(d):
    return cleaning.filter_international(d.news).select("record_id", "themes")


@query("parse_negative_tone", """
    SELECT record_id, neg_score FROM (SELECT record_id,
      TRY_CAST(str_split(tone, ',')[3] AS DOUBLE) AS neg_score FROM news)
    WHERE neg_score BETWEEN 0 AND 50""")
def _(d):
    return cleaning.parse_negative_tone(d.news).select("record_id", "neg_score")


@query("clean_news", "SELECT record_id, date, neg_score, category FROM clean")
def _(d):
    return cleaning.clean_news(d.news).select("record_id", "date", "neg_score", "category")


@query("filter_not_null", "SELECT record_id, category FROM news_rows WHERE category IS NOT NULL")
def _(d):
    return cleaning.drop_missing(d.news_rows, "category", "url").select("record_id", "category")


@query("tag_category_batch", "SELECT record_id, themes, category FROM news")
def _(d):
    return cleaning.tag_category_batch(d.news_rows).select("record_id", "themes", "category")


@query("tag_category_live", f"SELECT record_id, themes, {R.LIVE_CATEGORY} AS category "
       "FROM (SELECT * EXCLUDE (category) FROM news_rows)")
def _(d):
    return cleaning.tag_category_live(d.news_rows).select("record_id", "themes", "category")


_LISTS = "SELECT record_id, themes, {0} AS category FROM theme_lists"


def _looked_up(d: Derived, classes: themes.Classes, **bounds: int) -> DataFrame:
    """Classes of the theme lists by a dictionary learned from some of them."""
    return themes.classify(d.theme_lists, themes.learn(d.theme_lists, classes, **bounds)).select("record_id", "themes", "category")


@query("tag_category_lists", f"SELECT * FROM ({_LISTS.format(R.BATCH_CATEGORY)}) WHERE category IS NOT NULL")
def _(d):
    return cleaning.tag_category_batch(d.theme_lists).select("record_id", "themes", "category")


@query("tag_category_dictionary", f"SELECT * FROM ({_LISTS.format(R.BATCH_CATEGORY)}) WHERE category IS NOT NULL")
def _(d):
    tagged = themes.tag_category_batch(d.theme_lists, themes.learn(d.theme_lists, themes.BATCH))
    return tagged.select("record_id", "themes", "category")


@query("tag_category_small_dictionary", _LISTS.format(R.BATCH_CATEGORY))
def _(d):
    return _looked_up(d, themes.BATCH, cells=512, learned=40)


@query("tag_category_live_dictionary", _LISTS.format(R.LIVE_CATEGORY))
def _(d):
    return _looked_up(d, themes.LIVE)


@query("filter_theme_keywords_dictionary", f"SELECT record_id, themes FROM theme_lists WHERE {R.LIVE_THEMES}")
def _(d):
    dictionary = themes.learn(d.theme_lists, themes.KEYWORDS)
    return themes.filter_theme_keywords(d.theme_lists, dictionary).select("record_id", "themes")


@query("foreign_country_lists", """
    SELECT record_id, themes FROM theme_lists WHERE regexp_matches(themes, '#(U[A-RT-Z]|[A-TV-Z][A-Z])#')""")
def _(d):
    return cleaning.filter_international(d.theme_lists).select("record_id", "themes")


@query("title_rules", f"""
    SELECT url, title, live_title, coalesce({R.ARCHIVE_TITLE_OK}, false) AS archive_ok, coalesce({R.FEED_TITLE_OK}, false) AS feed_ok,
      coalesce({R.LIVE_TITLE_OK.replace('title', 'live_title')}, false) AS live_ok
    FROM (SELECT DISTINCT url, {R.archive_title('url')} AS title, {R.live_title('url')} AS live_title FROM theme_lists)""")
def _(d):
    titled = d.theme_lists.select("url").distinct().select(
        "url", news_text.url_to_title(F.col("url")).alias("title"), news_text.url_to_title_live(F.col("url")).alias("live_title"))
    rules = {"archive_ok": news_text.good_archive_title(F.col("title")), "feed_ok": news_text.good_feed_title(F.col("title")),
             "live_ok": news_text.good_live_title(F.col("live_title"))}
    return titled.withColumns({name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()})


@query("filter_theme_keywords", f"SELECT url, themes FROM live_raw WHERE {R.LIVE_THEMES}")
def _(d):
    return cleaning.filter_theme_keywords(d.live).select("url", "themes")


@query("filter_url_keywords", f"SELECT url FROM live_raw WHERE {R.LIVE_URL}")
def _(d):
    return cleaning.filter_url_keywords(d.live).select("url")


def _live_titles(d: Derived) -> DataFrame:
    return d.live.select("url", news_text.url_to_title_live(F.col("url")).alias("title"))


@query("url_to_title_live", "SELECT url, title FROM live_titled")
def _(d):
    return _live_titles(d)


@query("filter_title_quality_live", f"SELECT url, title FROM live_titled WHERE {R.LIVE_TITLE_OK}")
def _(d):
    return cleaning.filter_title_quality_live(_live_titles(d))


@query("filter_title_quality_feed", f"SELECT url, title FROM live_titled WHERE {R.FEED_TITLE_OK}")
def _(d):
    return cleaning.filter_title_quality_feed(_live_titles(d))


@query("url_to_title", f"SELECT url, {R.archive_title('url')} AS title FROM news")
def _(d):
    return d.news.select("url", news_text.url_to_title(F.col("url")).alias("title"))


@query("url_to_title_pages", f"""
    SELECT page_id, {R.archive_title('url')} AS title, {R.live_title('url')} AS live_title
    FROM pages""")
def _(d):
    url = F.col("url")
    return d.table("pages").select(
        "page_id", news_text.url_to_title(url).alias("title"),
        news_text.url_to_title_live(url).alias("live_title"),
    )


@query("filter_title_quality_archive", f"""
    SELECT url, title FROM (SELECT url, {R.archive_title('url')} AS title FROM news)
    WHERE {R.ARCHIVE_TITLE_OK}""")
def _(d):
    titled = d.news.select("url", news_text.url_to_title(F.col("url")).alias("title"))
    return cleaning.filter_title_quality_archive(titled)


_TEST_LABELS = ["Military Strike Watch", "Iran War", "Protest Wave", "War", "Sanction Talks"]
_LABELLED = f"""
    SELECT record_id, {R.archive_title('url')} AS title,
      {_TEST_LABELS}[CAST(record_id AS BIGINT) % 5 + 1] AS label FROM news"""


@query("label_keywords", f"""
    SELECT record_id, label, array_to_string(list_filter(list_transform(
      regexp_extract_all(label, '[A-Z][a-z]+'), lambda w: lower(w)), lambda w: w NOT IN
      ('war', 'tensions', 'protests', 'crisis', 'escalation', 'airstrikes', 'peak', 'ceasefire',
       'civil', 'political', 'geopolitical', 'border', 'strait')), ',') AS keywords
    FROM ({_LABELLED})""")
def _(d):
    labelled = d.news.select("record_id", pick(F.col("record_id"), _TEST_LABELS).alias("label"))
    words = F.array_join(news_text.label_keywords(F.col("label")), ",")
    return labelled.withColumn("keywords", words)


@query("filter_news_relevance", f"""
    SELECT record_id, title, label FROM ({_LABELLED})
    WHERE title IS NOT NULL AND {R.relevant('title', 'label')}""")
def _(d):
    labelled = d.news.select(
        "record_id", news_text.url_to_title(F.col("url")).alias("title"),
        pick(F.col("record_id"), _TEST_LABELS).alias("label"),
    )
    return cleaning.filter_news_relevance(labelled)


@query("drop_bad_time", """
    SELECT url, strftime(try_strptime(date, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS time
    FROM live_raw WHERE try_strptime(date, '%Y%m%d%H%M%S') IS NOT NULL""")
def _(d):
    timed = cleaning.drop_bad_time(d.live)
    return timed.select("url", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"))


@query("skip_bad_lines", """
    SELECT date, source, url, themes, tone FROM live_raw
    UNION ALL SELECT date, source, url, themes, tone FROM live_raw WHERE date LIKE '20240101%'""")
def _(d):
    return news_source.scan_live_news(d.spark, d.live_folder())


@query("filter_years", "SELECT record_id, date FROM dated WHERE year(date) BETWEEN 1996 AND 1998")
def _(d):
    dated = cleaning.parse_news_date(d.news).select("record_id", "date")
    return cleaning.filter_years(dated, 1996, 1998)


# --- Index


# A mean of 32 two-place numbers can end in a 5 at the seventh place, hence eight places for it.


@query("daily_tension", """
    SELECT date, total_events, round(avg_negative_tone, 8) AS avg_negative_tone,
      round(geo_tension_raw, 6) AS geo_tension_raw FROM daily""")
def _(d):
    daily = tension.daily_tension(cleaning.clean_news(d.news))
    return rounded(rounded(daily, "geo_tension_raw"), "avg_negative_tone", places=8)


@query("daily_profile", """
    SELECT date, total_events, round(avg_negative_tone, 8) AS avg_negative_tone, dominant_category,
      round(geo_tension_raw, 6) AS geo_tension_raw FROM idx_full""")
def _(d):
    profile = tension.daily_profile(cleaning.clean_news(d.news))
    return rounded(rounded(profile, "geo_tension_raw"), "avg_negative_tone", places=8)


@query("index_percentiles", "SELECT round(p1, 6) AS p1, round(p99, 6) AS p99 FROM percentiles")
def _(d):
    daily = tension.daily_tension(cleaning.clean_news(d.news))
    return rounded(tension.index_percentiles(daily), "p1", "p99")


@query("index_percentiles_approx", """
    SELECT 'p1' AS name, true AS within UNION ALL SELECT 'p99', true""")
def _(d):
    """Whether each approximate percentile has a rank within the error that its accuracy allows."""
    accuracy = 100
    daily = stage(tension.daily_tension(cleaning.clean_news(d.news)), "daily")
    return _ranks_within(daily, tension.index_percentiles(daily, accuracy), accuracy)


@query("index_percentiles_sketched", """
    SELECT 'p1' AS name, true AS within UNION ALL SELECT 'p99', true""")
def _(d):
    """The same for percentiles from sketches of the months, merged."""
    daily = stage(tension.daily_tension(cleaning.clean_news(d.news)), "daily")
    sketches = stage(tension.month_sketches(daily), "sketches")
    return _ranks_within(daily, tension.percentiles_of_sketches(sketches), tension.SKETCH_SIZE // 4)


_INDEX = "SELECT date, round(geo_tension_index, 6) AS geo_tension_index, total_events, dominant_category FROM idx"


@query("tension_index_in_five_loads", _INDEX)
def _(d):
    """The index after five loads, each of which reads its own articles only."""
    store = index_store.index_store(d.spark, scratch_path(d.spark, "index_store"), fan=3)
    part = F.pmod(F.xxhash64("record_id"), F.lit(5))
    for load in range(5):
        index_store.add_load(cleaning.clean_news(d.news.where(part == load)), store)
    return rounded(index_store.current_index(store).daily, "geo_tension_index")


@query("tension_index_from_updates", _INDEX)
def _(d):
    """News store and index in three overlapping updates."""
    store = index_store.index_store(d.spark, scratch_path(d.spark, "index_store"))
    path = scratch_path(d.spark, "news_store")
    part = F.col("record_id").cast("bigint") % 3
    for load in (part < 2, part > 0, part == 2):
        index_store.ingest_load(d.news.where(load), path, store, by="article_month")
    return rounded(index_store.current_index(store).daily, "geo_tension_index")


def _ranks_within(daily: DataFrame, found: DataFrame, accuracy: int) -> DataFrame:
    low, high = found.select("p1").scalar(), found.select("p99").scalar()
    ranks = daily.agg(*(
        F.sum((F.col("geo_tension_raw") <= value).cast("long")).alias(name) for name, value in (("p1", low), ("p99", high))
    ), F.count("geo_tension_raw").alias("n"))
    near = [F.abs(F.col(name) - share * F.col("n")) <= F.col("n") / accuracy + 1
            for name, share in (("p1", V.LOW_PERCENTILE), ("p99", V.HIGH_PERCENTILE))]
    return ranks.select(F.explode(F.array(
        F.struct(F.lit("p1").alias("name"), near[0].alias("within")),
        F.struct(F.lit("p99").alias("name"), near[1].alias("within")))).alias("x")).select("x.*")


@query("normalize_0_10", "SELECT date, round(geo_tension_index, 6) AS geo_tension_index FROM idx")
def _(d):
    daily = stage(tension.daily_tension(cleaning.clean_news(d.news)), "daily")
    index = tension.normalize_index(daily, tension.index_percentiles(daily))
    return rounded(index.select("date", "geo_tension_index"), "geo_tension_index")


@query("category_counts", "SELECT date, category, cat_count FROM cat_counts")
def _(d):
    return tension.category_counts(cleaning.clean_news(d.news))


@query("dominant_category", "SELECT date, dominant_category FROM dominant")
def _(d):
    return tension.dominant_category(tension.category_counts(cleaning.clean_news(d.news)))


@query("dominant_category_ties", """
    SELECT date, category AS dominant_category FROM cat_counts
    QUALIFY rank() OVER (PARTITION BY date ORDER BY cat_count DESC) = 1""")
def _(d):
    counts = tension.category_counts(cleaning.clean_news(d.news))
    return tension.dominant_category(counts, keep_ties=True)


@query("join_dominant_category", """
    SELECT date, total_events, dominant_category FROM daily LEFT JOIN dominant USING (date)""")
def _(d):
    clean = cleaning.clean_news(d.news)
    dominant = tension.dominant_category(tension.category_counts(clean))
    joined = tension.join_dominant_category(tension.daily_tension(clean), dominant)
    return joined.select("date", "total_events", "dominant_category")


@query("year_stats", """
    SELECT CAST(year(date) AS INTEGER) AS year, round(avg(geo_tension_index), 6) AS year_mean,
      round(stddev_samp(geo_tension_index), 6) AS year_std FROM idx GROUP BY 1""")
def _(d):
    return rounded(tension.year_stats(index_of(d).daily), "year_mean", "year_std")


@query("join_year_stats", """
    SELECT date, CAST(year AS INTEGER) AS year, round(year_mean, 6) AS year_mean,
      round(year_std, 6) AS year_std, round(threshold, 6) AS threshold FROM with_threshold""")
def _(d):
    joined = tension.join_year_stats(index_of(d).daily)
    return rounded(
        joined.select("date", "year", "year_mean", "year_std", "threshold"),
        "year_mean", "year_std", "threshold",
    )


@query("filter_spike", """
    SELECT date, true AS is_spike, round(threshold, 6) AS threshold FROM with_threshold
    WHERE geo_tension_index > threshold""")
def _(d):
    found = tension.filter_spike(tension.join_year_stats(index_of(d).daily))
    return rounded(found.select("date", "is_spike", "threshold"), "threshold")


@query("tension_index", """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index, total_events, dominant_category
    FROM idx""")
def _(d):
    return rounded(index_of(d).daily, "geo_tension_index")


_SPIKES = """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index, total_events,
      round(threshold, 6) AS threshold, is_spike, dominant_category FROM spikes"""


@query("spike_events", _SPIKES)
def _(d):
    return rounded(jobs.spike_events(index_of(d).daily), "geo_tension_index", "threshold")


@query("top_spikes", f"{_SPIKES} ORDER BY spikes.geo_tension_index DESC, date LIMIT 10")
def _(d):
    top = tension.top_spikes(jobs.spike_events(index_of(d).daily))
    return rounded(top, "geo_tension_index", "threshold")


@query("spike_events_2_sigma", """
    SELECT date, round(year_mean + 2 * year_std, 6) AS threshold FROM with_threshold
    WHERE geo_tension_index > year_mean + 2 * year_std""")
def _(d):
    found = jobs.spike_events(index_of(d).daily, sigmas=2.0)
    return rounded(found.select("date", "threshold"), "threshold")


@query("sorted_index", """
    SELECT date, round(geo_tension_index, 6) AS geo_tension_index FROM idx ORDER BY date""")
def _(d):
    path = scratch_path(d.spark, "sorted_index")
    index = index_of(d).daily.select("date", "geo_tension_index")
    tables.write_sorted(rounded(index, "geo_tension_index"), path, "date")
    return d.spark.read.parquet(path).orderBy("date")


@query("epoch_ns_to_date", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders""")
def _(d):
    nanos = F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000
    return d.table("orders").select("o_orderkey", calendar.epoch_ns_to_date(nanos).alias("day"))
