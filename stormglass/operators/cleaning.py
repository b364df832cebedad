"""Row filters and projections on news. No shuffle in any of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.functions import calendar, news_text


def parse_news_date(news: DataFrame) -> DataFrame:
    """Text date to DATE; rows without a valid day are dropped."""
    return news.withColumn("date", calendar.news_date(F.col("date"))).filter("date IS NOT NULL")


def filter_international(news: DataFrame) -> DataFrame:
    return news.filter(news_text.mentions_foreign_country(F.col("themes")))


def parse_negative_tone(news: DataFrame) -> DataFrame:
    """Adds neg_score; rows without a score in the valid range are dropped."""
    scored = news.withColumn("neg_score", news_text.negative_tone(F.col("tone")))
    return scored.filter(F.col("neg_score").between(V.TONE_MIN, V.TONE_MAX))


def clean_news(news: DataFrame) -> DataFrame:
    """Scored international articles: the input of the tension index."""
    return parse_negative_tone(filter_international(parse_news_date(news)))


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def tag_category_batch(news: DataFrame) -> DataFrame:
    """Adds the archive category; unclassified rows are dropped."""
    tagged = news.withColumn("category", news_text.batch_category(F.col("themes")))
    return tagged.filter("category IS NOT NULL")


def tag_category_live(news: DataFrame) -> DataFrame:
    return news.withColumn("category", news_text.live_category(F.col("themes")))


def filter_theme_keywords(news: DataFrame) -> DataFrame:
    return news.filter(F.col("themes").rlike(f"(?i){V.LIVE_THEME_WORDS}"))


def filter_url_keywords(news: DataFrame) -> DataFrame:
    return news.filter(F.lower("url").rlike(V.LIVE_URL_WORDS))


def filter_title_quality_live(news: DataFrame) -> DataFrame:
    return news.filter(news_text.good_live_title(F.col("title")))


def filter_title_quality_feed(news: DataFrame) -> DataFrame:
    return news.filter(news_text.good_feed_title(F.col("title")))


def filter_title_quality_archive(news: DataFrame) -> DataFrame:
    return news.filter(news_text.good_archive_title(F.col("title")))


def filter_news_relevance(news: DataFrame) -> DataFrame:
    """Rows whose title fits the label in the same row."""
    return news.filter(news_text.relevant_to_label(F.col("title"), F.col("label")))


def drop_bad_time(news: DataFrame) -> DataFrame:
    """Adds time; rows whose text date is no timestamp are dropped."""
    return news.withColumn("time", calendar.news_time(F.col("date"))).filter("time IS NOT NULL")


def filter_years(df: DataFrame, first: int = V.FIRST_YEAR, last: int = V.LAST_YEAR) -> DataFrame:
    # A range on the date itself reaches the file scan; year(date) would not.
    return df.filter(
        (F.col("date") >= F.lit(f"{first:04d}-01-01").cast("date"))
        & (F.col("date") <= F.lit(f"{last:04d}-12-31").cast("date"))
    )


def recent_slice(df: DataFrame, now: Column, days: int, column: str = "date") -> DataFrame:
    """Rows not older than a number of days before now."""
    start = now.cast("timestamp") - F.make_dt_interval(F.lit(days))
    return df.filter(F.col(column).cast("timestamp") >= start)


def same_day(df: DataFrame, now: Column, column: str = "timestamp") -> DataFrame:
    """Rows from the day of now on."""
    return df.filter(F.col(column) >= F.date_trunc("day", now))
