"""Inputs of the shapes the jobs read, derived by rule from the sample star schema.

Values are coded in integers before they become text or a price, so that any engine builds the
same bytes from the same tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass import schemas
from stormglass.functions import news_text
from stormglass.session import scratch_path, stage, use_utc
from stormglass.sources import news as news_source
from stormglass.sources import tables

FIRST_DAY = "1995-01-01"
SLUGS = [
    "military-strike-near-border-town", "sanction_talks_resume_in_capital", "short",
    "protest-threat-grows-in-decade",
]
WORDS = ["MILITARY", "SANCTION", "PROTEST", "DIPLOMATIC", "CEASEFIRE", "CYBERATTACK", "NUCLEAR", "SPORTS"]
COUNTRIES = ["US", "RS", "UP", "IR", "IS"]
THEME_CODES = [
    "MILITARY", "AWARD", "TAX_FNCACT_AUTHOR", "SOFTWARE", "EDUCATION", "SANCTION", "UNGP_FORESTS", "COUP", "diplomatic",
    "EXPORT_CONTROL", "WB_507_WATER", "NUCLEAR", "CEASEFIRE", "ESPIONAGE", "EXPULSION", "AIRSTRIKE", "RIOTOUS", "LEADER", "war",
]
TITLE_SLUGS = [
    "military-strike-near-border-town", "sanction_talks_resume_in_capital", "short", "protest-threat-grows-in-decade",
    "article-about-news-from-the-town", "deadbeef0011-report-on-border-talks", "bad-cafe-dead-beef-face-decade",
    "story-20240101123456789", "nospaceinthisveryveryverylongslug", "visit-site#now-for-more-border-news", "1234-5678-9012-3456-7890-12",
    "a-b-c-d-e-f-g-h-i-j-k-l-m-n", "troops-cross-the-river-in-the-north?page=2", "un-of-it-crisis-in-gaza-strip-today",
]
LIVE_WORDS = {"click": "MILITARY", "view": "SANCTION", "purchase": "diplomatic", "signup": "PROTEST"}
LABELS = ["Iran War", "Hong Kong Protests Peak", "Geopolitical Event"]
LIVE_FILES = 12
HOLDINGS = [("Brand#1", 30.0), ("Brand#10", 50.0), ("Brand#11", 20.0)]
HOLDINGS_UNKNOWN = [*HOLDINGS[:2], ("Brand#X", 20.0)]


def pick(key: Column, values: list[str]) -> Column:
    index = F.pmod(key.cast("bigint"), F.lit(len(values))).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def hundredths(value: Column) -> Column:
    """Integer of hundredths as a text with two decimals."""
    whole = F.call_function("div", value, F.lit(100).cast("bigint"))
    return F.concat(whole.cast("string"), F.lit("."), F.lpad((value % 100).cast("string"), 2, "0"))


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


class Derived:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def news_rows(self) -> DataFrame:
        """Articles from orders, some with a bad date, tone, country or no category.

        Stored, like the news file of the jobs: read inline, each filter on a derived text would
        build that text again.
        """
        key = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date")
        passed = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        shock = F.when(passed % 61 == 0, 3500).otherwise(0)
        tone = F.lit(500) + cents("o_totalprice") % 500 + shock
        rows = (
            self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                key.cast("string").alias("record_id"),
                F.when(key % 107 == 0, "2022")
                .otherwise(F.concat(F.date_format(day, "yyyyMMdd"), F.lit("120000"))).alias("date"),
                F.concat(F.lit("src"), F.col("o_custkey") % 20, F.lit(".example")).alias("source"),
                F.concat(F.lit("https://news.example/a/"), pick(key, SLUGS), F.lit("-"), key,
                         F.lit(".html")).alias("url"),
                F.concat(pick(key, WORDS), F.lit("#3##1#X#"), pick(F.col("c_nationkey"), COUNTRIES),
                         F.lit("#")).alias("themes"),
                F.when(key % 101 == 0, "bad").when(key % 103 == 0, "0,1,99.00,0")
                .otherwise(F.concat(F.lit("0,1,"), hundredths(tone), F.lit(",0"))).alias("tone"),
            )
            .withColumn("category", news_text.batch_category(F.col("themes")))
        )
        return stage(rows, "news_rows")

    @property
    def news(self) -> DataFrame:
        return self.news_rows.filter("category IS NOT NULL")

    def news_file(self) -> str:
        path = scratch_path(self.spark, "news_tsv")
        self.news.write.options(sep="\t", quote="").csv(path)
        return path

    def raw_news_folder(self, filler: int = 0, times: int = 1, kept_every: int = 1) -> str:
        """Raw lines of 27 fields, used ones at their places. With filler the theme lists are longer by about so many
        characters, of 3,000 codes without a class; one line in kept_every has a word with one; the same lines are written times times."""
        path = scratch_path(self.spark, "raw_news")
        used = schemas.RAW_NEWS_FIELDS
        fields = [
            F.coalesce(F.col(used[i]), F.lit("")) if i in used else F.lit(f"f{i}")
            for i in range(1, schemas.RAW_NEWS_WIDTH + 1)
        ]
        rows = self.news_rows
        if kept_every > 1:
            plain = F.concat(F.lit("SPORTS#"), F.substring_index("themes", "#", -5))
            rows = rows.withColumn("themes", F.when(F.crc32("record_id") % kept_every == 0, F.col("themes")).otherwise(plain))
        if filler:
            codes = F.transform(F.sequence(F.lit(1), F.lit(max(1, filler // 17))), lambda k: F.concat(
                F.lit("TAX_THEME_ID"), F.pmod(F.hash("record_id", k), F.lit(3000)).cast("string")))
            rows = rows.withColumn("themes", F.concat_ws(";", "themes", F.array_join(codes, ";")))
        lines = rows.select(F.concat_ws("\t", *fields).alias("value"))
        for _ in range(times):
            lines.write.mode("append").text(path)
        return path

    @cached_property
    def prices(self) -> DataFrame:
        """Mean price per day and brand, to four places; days without a sale are missing."""
        sums = (
            self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col("p_brand").alias("ticker"))
            .agg(F.sum(cents("l_extendedprice")).alias("c"),
                 F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
        )
        rounded = F.floor(F.col("c") * F.lit(100.0) / F.col("q") + 0.5) / F.lit(10000.0)
        return sums.select("date", "ticker", rounded.alias("close"))

    def wide_price_folder(self) -> list[str]:
        """Wide price files, one folder per group of years; the first lacks one brand."""
        wide = self.prices.groupBy("date").pivot("ticker").agg(F.first("close"))
        nanos = (F.unix_micros(F.col("date").cast("timestamp")) * 1000).alias("Date")
        names = [c for c in wide.columns if c != "date"]
        first_year = F.year("date") == 1995
        path = scratch_path(self.spark, "wide_prices")
        rest = [F.col(f"`{c}`") for c in names]
        wide.filter(first_year).select(nanos, *rest[1:]).write.parquet(f"{path}/first")
        wide.filter(~first_year).select(nanos, *rest).write.parquet(f"{path}/later")
        return [f"{path}/first", f"{path}/later"]

    @cached_property
    def sectors(self) -> DataFrame:
        """Brands by name, the first 21 in turn to the sectors."""
        sorted_brands = self.table("part").agg(F.array_sort(F.collect_set("p_brand")).alias("b"))
        placed = sorted_brands.select(F.posexplode("b").alias("pos", "ticker")).filter("pos < 21")
        return placed.select(pick(F.col("pos"), list(V.SECTOR_TICKERS)).alias("sector"), "ticker")

    def portfolio(self, holdings=tuple(HOLDINGS)) -> DataFrame:
        return tables.literal_portfolio(self.spark, holdings)

    def labels(self, dates: DataFrame) -> DataFrame:
        """Known labels for about a third of the days."""
        passed = F.datediff("date", F.lit(FIRST_DAY).cast("date"))
        third = F.floor((passed % 9) / 3)
        return dates.filter(passed % 3 == 0).select("date", pick(third, LABELS).alias("label"))

    @cached_property
    def vix(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        rows = self.table("orders").select(day.alias("date"), cents("o_totalprice").alias("c"))
        weekdays = rows.filter(F.weekday("date") < 5)
        mean_cents = F.sum("c") / F.count("*")
        return weekdays.groupBy("date").agg(
            (F.floor(mean_cents / 100 + 0.5) / F.lit(10000.0)).alias("vix")
        )

    @cached_property
    def live(self) -> DataFrame:
        """Live articles from events, in the used fields of a live file; stored like the news.

        Some come twice with another tone, as when an article is read again.
        """
        key = F.col("event_id")
        theme = F.lit("SPORTS")
        for event_type, word in LIVE_WORDS.items():
            theme = F.when(F.col("event_type") == event_type, word).otherwise(theme)
        hundred = F.abs(F.round(F.col("value") * 100).cast("bigint"))
        tones = F.when(key % 41 == 0, F.array(hundred % 5000, (hundred + 700) % 5000)).otherwise(F.array(hundred % 5000))
        tone = F.col("tone_hundredths")
        rows = self.table("events").withColumn("tone_hundredths", F.explode(tones)).select(
            F.when(key % 97 == 0, "soon").otherwise(F.date_format("ts", "yyyyMMddHHmmss")).alias("date"),
            F.concat(F.lit("src"), F.col("user_id") % 20).alias("source"),
            F.concat(F.lit("https://live.example/"), pick(key, SLUGS), F.lit("-"), key,
                     F.lit(".html")).alias("url"),
            theme.alias("themes"),
            F.concat(F.lit("0,1,"), hundredths(tone), F.lit(",0")).alias("tone"),
        )
        return stage(rows, "live")

    def live_folder(self) -> str:
        """Live files in the order of time, one of late rows, one that comes again, and lines with too many fields."""
        path = scratch_path(self.spark, "live_news")
        used = schemas.LIVE_NEWS_FIELDS
        fields = [
            F.coalesce(F.col(used[i]), F.lit("")) if i in used else F.lit(f"f{i}")
            for i in range(schemas.RAW_NEWS_WIDTH)
        ]
        is_late = F.crc32("url") % 53 == 0
        lines = self.live.select("date", is_late.alias("late"), F.concat_ws("\t", *fields).alias("value"))
        in_time = lines.filter("NOT late").repartitionByRange(LIVE_FILES, "date")
        again, too_long = (lines.filter(F.col("date").startswith(d)) for d in ("20240101", "20240102"))
        for part in (in_time, lines.filter("late").coalesce(1), again.coalesce(1),
                     too_long.withColumn("value", F.concat("value", F.lit("\tmore"))).coalesce(1)):
            part.select("value").write.mode("append").text(path)
        return path

    @cached_property
    def theme_lists(self) -> DataFrame:
        """Articles with lists of several themes in all orders, words inside other words, several countries, and slugs
        for each rule on titles. Some lists are empty or missing."""
        key = F.col("o_orderkey")
        codes = F.concat_ws(";", pick(key, THEME_CODES), pick(key * 7 + F.col("o_custkey"), THEME_CODES),
                            pick(F.col("o_custkey"), THEME_CODES))
        places = F.concat(F.lit(";1#X#"), pick(key, COUNTRIES), F.lit("#;4#Y#"), pick(F.col("o_custkey"), COUNTRIES), F.lit("#"))
        rows = self.table("orders").select(
            key.cast("string").alias("record_id"),
            F.when(key % 89 == 0, F.lit(None)).when(key % 83 == 0, "").otherwise(F.concat(codes, places)).alias("themes"),
            F.concat(F.lit("https://news.example/"), pick(key, TITLE_SLUGS), F.when(key % 3 == 0, "/").otherwise(".html")).alias("url"))
        return stage(rows, "theme_lists")

    def file_listing(self) -> DataFrame:
        """Lines of a file list: size, hash, path; a third of them for raw news."""
        key = F.col("o_orderkey")
        kind = pick(key, [".gkg.csv.zip", ".export.CSV.zip", ".mentions.CSV.zip"])
        day = F.date_format(F.col("o_orderdate"), "yyyyMMdd")
        path = F.concat(F.lit("http://archive.example/v2/"), day, F.lit("120000"), kind)
        return self.table("orders").select(
            F.concat_ws(" ", key.cast("string"), F.md5(key.cast("string")), path).alias("value")
        )

    def as_articles(self) -> DataFrame:
        return news_source.as_articles(self.news)
