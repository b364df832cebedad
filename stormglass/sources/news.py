"""News sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stormglass import schemas
from stormglass.fixed_values import TONE_MAX, TONE_MIN
from stormglass.functions import calendar, news_text
from stormglass.operators import cleaning, themes
from stormglass.session import stage

# Quotes are data in these files: an unbalanced one must not swallow the next fields.
_TSV = {"sep": "\t", "quote": "", "header": "false"}

# Suffix of raw news archives, and the place of the path in a file list line.
RAW_SUFFIX = r"\.gkg\.csv"
PATH_FIELD = 3

#: Ends of an open year range in file names.
EARLIEST_YEAR, LATEST_YEAR = 1900, 2199


def scan_news_tsv(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(schemas.FILTERED_NEWS).options(**_TSV).csv(list(paths))


def as_articles(news: DataFrame) -> DataFrame:
    """Renamed columns of the filtered news, for the news join; rows need a URL and a day."""
    renamed = news.select(
        F.col("date").alias("datetime"), F.col("source").alias("domain"), "url", "themes", "category"
    )
    dated = cleaning.drop_missing(renamed, "url", "datetime").withColumn(
        "article_date", calendar.news_date(F.col("datetime"))
    )
    return dated.filter("article_date IS NOT NULL")


def scan_news_positional(spark: SparkSession, *paths: str) -> DataFrame:
    return as_articles(scan_news_tsv(spark, *paths))


def raw_file_names(first_year: int | None = None, last_year: int | None = None) -> str:
    """Pattern of the names of raw files: all, or those that begin with a year of the range."""
    if first_year is None and last_year is None:
        return "*.csv*"
    # Names of files of other years are not even opened.
    years = range(first_year or EARLIEST_YEAR, (last_year or LATEST_YEAR) + 1)
    return f"{{{','.join(map(str, years))}}}*.csv*"


def scan_raw_news(
    spark: SparkSession, *paths: str, first_year: int | None = None, last_year: int | None = None,
) -> DataFrame:
    """Raw lines (plain or gzip text) of all files below the paths, of some years if asked for; only the six used
    fields are materialised."""
    options = {**_TSV, "recursiveFileLookup": "true"}
    if first_year is not None or last_year is not None:
        options["pathGlobFilter"] = raw_file_names(first_year, last_year)
    raw = spark.read.schema(schemas.raw_news()).options(**options).csv(list(paths))
    return raw.select(*schemas.RAW_NEWS_FIELDS.values())


def prune_files_by_year(listing: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Paths of raw news files in the year range, from lines of "size hash path"."""
    years = "|".join(str(y) for y in range(first_year, last_year + 1))
    path = F.get(F.split(F.trim("value"), r"\s+"), F.lit(PATH_FIELD - 1))
    return (
        listing.filter(F.col("value").rlike(RAW_SUFFIX))
        .select(path.alias("path"))
        .filter(F.col("path").rlike(f"/({years})"))
    )


def ingest_raw_news(raw: DataFrame, dictionary: themes.Dictionary | None = None) -> DataFrame:
    """Classified articles of the raw archive, in the layout of the filtered news. Theme lists are scanned, or looked up in
    a dictionary of codes, which gives the same classes several times as fast."""
    tagged = cleaning.tag_category_batch(raw) if dictionary is None else themes.tag_category_batch(raw, dictionary)
    return tagged.select(*schemas.FILTERED_NEWS.names)


def as_store_rows(news: DataFrame) -> DataFrame:
    """Filtered news with what later jobs would parse again: day, score, foreign mention."""
    return news.select(
        "record_id", "date", "source", "url", "themes", "tone", "category",
        news_text.negative_tone(F.col("tone")).alias("neg_score"),
        news_text.mentions_foreign_country(F.col("themes")).alias("is_foreign"),
        calendar.news_date(F.col("date")).alias("article_date"),
    ).withColumn("article_month", calendar.month(F.col("article_date")))


def write_news_store(
    news: DataFrame, path: str, by: str = "article_date", update: bool = False
) -> int:
    """News table partitioned by day, or by "article_month" where days are small; the number of rows written.

    Replaces the whole table, or with update adds the articles that it does not hold yet.

    The rebalance before the write gives each partition few files, and splits one that holds a
    large share of all rows over several tasks. Rows without a valid day go to a NULL partition.
    """
    rows = as_store_rows(news)
    if update:
        rows = not_stored(rows, path, by)
    return _write_store(rows, path, by, "append" if update else "overwrite")


def _write_store(rows: DataFrame, path: str, by: str, mode: str) -> int:
    seen = Observation()
    writer = rows.hint("rebalance", by).observe(seen, F.count("*").alias("n")).write.mode(mode)
    writer.option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
    return seen.get["n"]


def append_to_store(rows: DataFrame, path: str, by: str = "article_date") -> int:
    """Add rows that the store lacks, as not_stored gives them."""
    return _write_store(rows, path, by, "append")


def not_stored(rows: DataFrame, path: str, by: str) -> DataFrame:
    """One row of each record_id that the partitions of the rows do not hold yet; rows without one are all kept.

    A load that failed or is run again adds nothing twice, and no stored row is touched.
    """
    spark = rows.sparkSession
    rest = [c for c in rows.columns if c != "record_id"]
    first = rows.where("record_id IS NOT NULL").groupBy("record_id").agg(F.min(F.struct(*rest)).alias("first"))
    unique = first.select("record_id", "first.*").select(*rows.columns)
    fresh = stage(unique.unionByName(rows.where("record_id IS NULL")), "load")
    if not store_exists(spark, path):
        return fresh
    stored = scan_news_store(spark, path)
    known = stored.where(_in_partitions(stored, by, fresh)).select(F.col("record_id").alias("known_id"))
    return fresh.join(known, F.col("record_id") == F.col("known_id"), "left_anti")


#: Partitions that a load may touch to be named one by one; a load of more names the range from the first to the last.
NAMED_PARTITIONS = 4096


def _in_partitions(stored: DataFrame, by: str, load: DataFrame) -> Column:
    """Condition on the partition column, with the values of a load as literals: the scan lists no other partition."""
    kind = stored.schema[by].dataType
    touched = load.select(F.col(by).cast(kind).alias("part")).distinct()
    extent = touched.agg(F.count("part").alias("n"), F.min("part").alias("first"), F.max("part").alias("last"),
                         F.coalesce(F.bool_or(F.col("part").isNull()), F.lit(False)).alias("none")).first()
    if extent["n"] > NAMED_PARTITIONS:
        named = F.col(by).between(F.lit(extent["first"]), F.lit(extent["last"]))
    else:
        values = [r["part"] for r in touched.where("part IS NOT NULL").collect()]
        named = F.col(by).isin(values) if values else F.lit(False)
    return (F.col(by).isNull() | named) if extent["none"] else named


def store_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def scan_news_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def store_as_clean(store: DataFrame) -> DataFrame:
    """Input of the tension index from the store: reads day, score, category, flag only."""
    return store.filter(
        F.col("article_date").isNotNull()
        & F.col("is_foreign")
        & F.col("neg_score").between(TONE_MIN, TONE_MAX)
    ).select(F.col("article_date").alias("date"), "neg_score", "category")


def store_as_articles(store: DataFrame) -> DataFrame:
    rows = store.filter("article_date IS NOT NULL AND url IS NOT NULL")
    return rows.select(
        F.col("source").alias("domain"), "url", "themes", "category", "article_date",
        "article_month",
    )


def live_fields(lines: DataFrame, width: int = schemas.RAW_NEWS_WIDTH) -> DataFrame:
    """Used fields of live lines; lines with more than the expected fields are skipped."""
    parts = lines.select(F.split("value", "\t").alias("f")).filter(F.size("f") <= width)
    fields = schemas.LIVE_NEWS_FIELDS.items()
    return parts.select(
        *[F.nullif(F.get("f", F.lit(i)), F.lit("")).alias(name) for i, name in fields]
    )


def checked_live_lines(lines: DataFrame, width: int = schemas.RAW_NEWS_WIDTH) -> DataFrame:
    """The lines (value and other columns) with their used fields, and the reason why one is no article (NULL if it is one)."""
    fields = F.split("value", "\t")
    parts = lines.withColumn("f", fields)
    named = {name: F.nullif(F.get("f", F.lit(i)), F.lit("")) for i, name in schemas.LIVE_NEWS_FIELDS.items()}
    reason = F.when(F.size("f") > width, "too many fields").when(
        calendar.news_time(named["date"]).isNull(), "no valid time")
    return parts.select(*lines.columns, *(c.alias(name) for name, c in named.items()), reason.alias("reason"))


def scan_live_news(spark: SparkSession, path: str) -> DataFrame:
    return live_fields(spark.read.schema(schemas.LIVE_TEXT).text(path))
