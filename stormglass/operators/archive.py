"""Supporting news of spikes, labels, and the sector view of one event."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.functions import calendar, measures, news_text
from stormglass.operators import cleaning
from stormglass.operators.windows import event_window_join, nearest_date, top_per_group
from stormglass.session import stage

#: Map tasks of one group that are ranked together before its last ranking.
TOP_BUCKETS = 32

NEWS_COLUMNS = [
    "spike_date", "dominant_category", "article_date", "domain", "url", "themes",
    "days_from_spike", "title",
]


def news_window_join(
    articles: DataFrame, spikes: DataFrame, low: int = V.NEWS_WINDOW[0],
    high: int = V.NEWS_WINDOW[1], **join_options,
) -> DataFrame:
    """Articles within some days of a spike. Articles hold article_date, domain, url, themes."""
    events = spikes.select(F.col("date").alias("spike_date"), "dominant_category")
    if "article_month" in articles.columns:
        join_options["fact_month"] = "article_month"
    return event_window_join(
        articles, "article_date", events, "spike_date", low, high, **join_options
    ).select(*NEWS_COLUMNS[:-1])


def add_titles(windowed: DataFrame) -> DataFrame:
    """Adds the title; rows without one are dropped.

    A filter would be moved below the window join and so run on all articles. As a generated
    column the title is made once, for articles inside a window only.
    """
    titles = F.filter(F.array(news_text.slug_words(F.col("url"))), news_text.long_enough)
    return windowed.withColumn("title", F.explode(titles))


def top_news_per_spike(
    titled: DataFrame, n: int = V.NEWS_PER_SPIKE, closest_first: bool = False
) -> DataFrame:
    """First n articles per spike by day offset, from the earliest day of the window on."""
    order = [F.col(c).asc() for c in ("days_from_spike", "url", "domain", "themes")]
    if closest_first:
        order = [F.abs("days_from_spike").asc(), *order]
    return top_per_group(
        titled, ["spike_date"], order, n, buckets=TOP_BUCKETS
    )


def news_around_date(archive: DataFrame, dates: DataFrame) -> DataFrame:
    """Archive rows, of whatever spike, within three days of the given dates."""
    wanted = dates.select(F.col("date").alias("event_date"))
    return event_window_join(
        archive.drop("days_from_spike"), "article_date", wanted, "event_date", *V.NEWS_WINDOW,
        offset="days_from_event",
    )


def title_words(around: DataFrame) -> DataFrame:
    """The words of the titles near each date, without stopwords."""
    words = F.regexp_extract_all(F.lower("title"), F.lit(V.TITLE_WORD), F.lit(0))
    exploded = around.select("event_date", F.explode(words).alias("word"))
    return exploded.filter(~F.col("word").isin(V.TITLE_STOPWORDS))


def keyword_counts(around: DataFrame) -> DataFrame:
    """Word frequency in the titles near each date."""
    return title_words(around).groupBy("event_date", "word").agg(F.count("*").alias("n"))


#: Words that a sketch of a date tracks, and candidates that it gives.
TRACKED_WORDS, CANDIDATE_WORDS = 10_000, 64


def frequent_word_counts(
    around: DataFrame, top: int = 3, tracked: int = TRACKED_WORDS, candidates: int = CANDIDATE_WORDS
) -> DataFrame:
    """Counts as keyword_counts has them, but of the words only that can be among the first ``top`` of a date.

    A sketch of bounded size per date, merged from those of all tasks, names candidates, and a second pass counts these exactly. A word
    that is no candidate occurs at most as often as the error of the sketch allows (twice 3.5 / 0.75 of all words through the
    number tracked) and as the last candidate is estimated. Dates whose ``top``-th count is not above that are counted in full. Memory per
    date is bounded; what is shuffled is the sketches, and rows of candidates.
    """
    words = title_words(around)
    sketches = words.groupBy("event_date").agg(
        F.call_function("approx_top_k_accumulate", F.col("word"), F.lit(tracked)).alias("sketch"), F.count("*").alias("words"))
    found = sketches.select("event_date", "words", F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(candidates)).alias("c"))
    last = F.when(F.size("c") >= candidates, F.get("c", F.size("c") - 1)["count"]).otherwise(0)
    bound = F.greatest(F.ceil(F.col("words") * (2 * 3.5 * 0.75 / tracked)), last).alias("bound")
    named = stage(found.select("event_date", bound, F.transform("c", lambda x: x["item"]).alias("c")), "candidates")
    listed = named.select("event_date", F.explode("c").alias("word"))
    counts = stage(words.join(listed, ["event_date", "word"], "left_semi").groupBy("event_date", "word").agg(F.count("*").alias("n")),
                   "counted")
    reached = counts.groupBy("event_date").agg(F.sort_array(F.collect_list("n"), asc=False).alias("n"))  # few per date
    proven = named.join(reached, "event_date", "left").select(
        "event_date", F.coalesce(F.get("n", F.lit(top - 1)) > F.col("bound"), F.lit(False)).alias("proven"))
    open_dates = stage(proven.where("NOT proven").select("event_date"), "open")
    rest = words.join(open_dates, "event_date", "left_semi").groupBy("event_date", "word").agg(F.count("*").alias("n"))
    return counts.join(open_dates, "event_date", "left_anti").unionByName(rest)


def auto_labels(counts: DataFrame) -> DataFrame:
    """Label from the three most frequent words."""
    top = top_per_group(counts, ["event_date"], [F.col("n").desc(), F.col("word").asc()], 3)
    ordered = F.array_sort(F.collect_list(F.struct(-F.col("n"), F.col("word"))))
    words = F.transform(ordered, lambda s: F.initcap(s["word"]))
    return top.groupBy(F.col("event_date").alias("date")).agg(
        F.array_join(words, V.LABEL_SEPARATOR).alias("auto_label")
    )


def join_labels(
    spikes: DataFrame, known: DataFrame, auto: DataFrame | None = None
) -> DataFrame:
    """Known label of the date, else the automatic one, else a constant."""
    labelled = spikes.join(known, "date", "left")
    choices = [F.col("label")]
    if auto is not None:
        labelled = labelled.join(auto, "date", "left")
        choices.append(F.col("auto_label"))
    chosen = F.coalesce(*choices, F.lit(V.FALLBACK_LABEL))
    return labelled.select(*spikes.columns, chosen.alias("label"))


def spike_labels(spikes: DataFrame, known: DataFrame, archive: DataFrame, tracked: int | None = None) -> DataFrame:
    """Spikes with their labels; ``tracked`` finds the words of automatic ones by sketches, see frequent_word_counts."""
    around = news_around_date(archive, spikes)
    counts = keyword_counts(around) if tracked is None else frequent_word_counts(around, tracked=tracked)
    return join_labels(spikes, known, auto_labels(counts))


def spike_options(labelled: DataFrame) -> DataFrame:
    """Texts to pick an event from, newest first."""
    text = F.concat_ws(" | ", calendar.day_text(F.col("date")), "label")
    return labelled.orderBy(F.col("date").desc()).select("date", text.alias("option"))


def supporting_news(archive: DataFrame, labelled: DataFrame, n: int = 6) -> DataFrame:
    """Good titles near each event that fit its label, first n in a fixed order."""
    around = news_around_date(archive, labelled).join(
        labelled.select(F.col("date").alias("event_date"), "label"), "event_date"
    )
    fitting = cleaning.filter_news_relevance(cleaning.filter_title_quality_archive(around))
    order = ["article_date", "spike_date", "url", "domain"]
    return top_per_group(
        fitting.select("event_date", "label", "article_date", "spike_date", "domain", "url", "title"),
        ["event_date"], [F.col(c).asc() for c in order], n, buckets=TOP_BUCKETS,
    )


def join_sector(rows: DataFrame, sectors: DataFrame) -> DataFrame:
    """Adds the sector of the ticker; tickers without one are dropped."""
    return rows.join(sectors, "ticker")


def nearest_spike_match(wanted: DataFrame, reactions: DataFrame) -> DataFrame:
    """The reaction date to show for each wanted spike date."""
    return nearest_date(
        wanted.select("date"), reactions.select(F.col("spike_date").alias("date"))
    )


def target_offset(rows: DataFrame, group: str = "spike_date", goal: int = V.TARGET_OFFSET) -> DataFrame:
    """Positive day offset closest to the goal per group; the smaller of two equals."""
    after = rows.filter("days_from_spike > 0")
    # Distance and side in one number, so that a plain minimum finds the offset.
    side = (F.col("days_from_spike") > goal).cast("int")
    code = F.min(F.abs(F.col("days_from_spike") - goal) * 2 + side).alias("_code")
    distance = F.floor(F.col("_code") / 2).cast("int")
    offset = F.when(F.col("_code") % 2 == 1, goal + distance).otherwise(goal - distance)
    return after.groupBy(group).agg(code).select(group, offset.alias("target_offset"))


def sector_reaction(reactions: DataFrame, sectors: DataFrame) -> DataFrame:
    """Mean return per spike and sector at the target offset of the spike."""
    mapped = join_sector(reactions, sectors)
    offsets = target_offset(mapped)
    at_target = mapped.join(offsets, "spike_date").filter("days_from_spike = target_offset")
    return at_target.groupBy("spike_date", "target_offset", "sector").agg(
        F.avg("avg_return_pct").alias("avg_return_pct")
    )


def with_bar_width(rows: DataFrame, value: str, group: list[str]) -> DataFrame:
    """Adds the bar length of a value relative to the largest in its group."""
    largest = rows.groupBy(*group).agg(F.max(F.abs(value)).alias("max_abs"))
    joined = rows.join(largest, group) if group else rows.withColumn("max_abs", largest.scalar())
    return joined.withColumn("bar_width", measures.bar_width(F.col(value), F.col("max_abs")))


def sector_impact(wanted: DataFrame, reactions: DataFrame, sectors: DataFrame) -> DataFrame:
    """Sector view for every wanted spike date, by its nearest date with prices."""
    matched = nearest_spike_match(wanted, reactions)
    by_sector = sector_reaction(reactions, sectors).withColumnRenamed("spike_date", "nearest_date")
    return matched.join(by_sector, "nearest_date").select(
        "date", "nearest_date", "target_offset", "sector", "avg_return_pct"
    )


def overlay_vix(index: DataFrame, vix: DataFrame) -> DataFrame:
    """Index and volatility on one date axis; days without trading keep NULL."""
    return index.join(vix, "date", "left").select("date", "geo_tension_index", "vix")


def window_slice(series: DataFrame, spikes: DataFrame) -> DataFrame:
    """Rows of a daily series within five days of each spike."""
    wanted = spikes.select(F.col("date").alias("spike_date"))
    return event_window_join(series, "date", wanted, "spike_date", *V.CHART_WINDOW)


def intraday_return(prices: DataFrame, key: str, time: str, close: str, tie: str | None = None) -> DataFrame:
    """First to last close in percent; 0 with fewer than two rows.

    Time and tie become one decimal, so that plain hash aggregation finds both ends.
    """
    order = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(19,0)")
    if tie:
        order = order * F.lit("10000000000000000000").cast("decimal(20,0)") + F.col(tie)
    order = order.cast("decimal(38,0)")
    ends = prices.groupBy(key).agg(
        F.min_by(close, order).alias("_first"),
        F.max_by(close, order).alias("_last"),
        F.count("*").alias("_n"),
    )
    change = F.when(F.col("_n") >= 2, measures.return_pct(F.col("_last"), F.col("_first")))
    return ends.select(key, F.coalesce(change, F.lit(0.0)).alias("return_pct"))


def sector_fund_returns(funds: DataFrame, returns: DataFrame) -> DataFrame:
    """Return of each sector's fund; 0 where the fund has no prices today."""
    joined = funds.join(returns, "etf", "left")
    return joined.select("sector", F.coalesce("return_pct", F.lit(0.0)).alias("avg")).orderBy(
        F.col("avg").desc(), "sector"
    )


def live_articles(raw: DataFrame) -> DataFrame:
    """Filters, category, headline and time of newly arrived articles."""
    wanted = cleaning.filter_url_keywords(cleaning.filter_theme_keywords(raw))
    titled = cleaning.tag_category_live(wanted).withColumn(
        "title", news_text.url_to_title_live(F.col("url"))
    )
    return cleaning.drop_bad_time(cleaning.filter_title_quality_live(titled))


def latest_news(articles: DataFrame, n: int = 10) -> DataFrame:
    newest = [F.col("time").desc(), F.col("title").asc(), F.col("source").asc(), F.col("category").asc()]
    return articles.select("time", "title", "source", "category").orderBy(*newest).limit(n)


def feed_items(newest: DataFrame, n: int = 6) -> DataFrame:
    """What the feed shows: clean titles with their clock time."""
    order = [F.col("time").desc(), F.col("title").asc(), F.col("source").asc()]
    shown = cleaning.filter_title_quality_feed(newest).orderBy(*order).limit(n)
    return shown.withColumn("clock", calendar.clock(F.col("time")))


def with_market_state(rows: DataFrame, time: str) -> DataFrame:
    return rows.withColumn("market_open", calendar.market_open(F.col(time)))


def live_chart(
    now: Column, readings: DataFrame, vix_minutes: DataFrame, index: DataFrame, vix_daily: DataFrame,
    days: int = V.CHART_WINDOW[1],
) -> DataFrame:
    """Points of the live chart: today's readings in market hours, else the last days.

    With a literal now the market state is folded and only the branches needed are planned.
    """
    is_open = calendar.market_open(now)

    def points(rows: DataFrame, name: str, time: str, value: str) -> DataFrame:
        return rows.select(
            F.lit(name).alias("series"), F.col(time).cast("timestamp").alias("time"),
            F.col(value).cast("double").alias("value"),
        )

    today = [
        points(cleaning.same_day(readings, now), "tension", "timestamp", "tension_score"),
        points(cleaning.same_day(vix_minutes, now), "vix", "timestamp", "vix"),
    ]
    recent = [
        points(cleaning.recent_slice(index, now, days), "tension", "date", "geo_tension_index"),
        points(cleaning.recent_slice(vix_daily, now, days), "vix", "date", "vix"),
    ]
    branches = [p.filter(is_open) for p in today] + [p.filter(~is_open) for p in recent]
    return reduce(DataFrame.unionByName, branches)
