"""Live news as one stream: articles as they arrive are stored once, and all live tables follow from what a batch changes.

No state is kept in the stream and nothing is dropped for being late: a row counts whenever it comes, in whatever
batch. A batch reads the stored rows that have keys of its own, writes the rows that are new or replace another one, and adds
what they change to the readings: new rows count, replaced ones are taken back.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stormglass import schemas
from stormglass.functions import calendar, measures
from stormglass.operators import archive, cleaning
from stormglass.sources.news import checked_live_lines, live_fields
from stormglass.streaming.segments import FAN, Kind, Manifest, Store

READING = "15 minutes"
NEWEST = 10
#: Rows that are searched for each of the newest articles at first, and the factor by which they grow if that is not enough.
TITLED, WIDER = 100, 100
NO_LINES = {"lines": 0, "kept": 0, "quarantined": 0}
_FIELDS = list(schemas.LIVE_NEWS_FIELDS.values())
_REST = [c for c in _FIELDS if c != "url"]
#: Scores are summed as decimals, so that the order of rows, and taking rows back, changes no digit.
_EXACT = "decimal(28,16)"


def read_live_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Lines of new files, with the file of each."""
    lines = (
        spark.readStream.schema(schemas.LIVE_TEXT)
        .option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true")
        .format("text").load(folder)
    )
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def read_live_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return live_fields(read_live_lines(spark, folder, files_per_batch))


def _first_of_each(timed: DataFrame) -> DataFrame:
    rest = [c for c in timed.columns if c not in ("url", "time")]
    first = timed.groupBy("url", "time").agg(F.min(F.struct(*rest)).alias("first"))
    return first.select(*(F.col(c) if c in ("url", "time") else F.col(f"first.{c}") for c in timed.columns))


def drop_repeated(raw: DataFrame) -> DataFrame:
    """One row per article, told apart by url and time: the smallest of those that differ in other fields.

    Rows without a valid time go. Batch and stream use the same rule, so neither the order of rows nor that of
    files matters.
    """
    return _first_of_each(cleaning.drop_bad_time(raw))


def _counted(rows: DataFrame, reading: str = READING) -> DataFrame:
    """(timestamp, neg_score) of the rows that count for the readings."""
    wanted = cleaning.filter_theme_keywords(cleaning.parse_negative_tone(rows))
    return wanted.select(F.window("time", reading)["start"].alias("timestamp"), "neg_score")


def _scores(partials: DataFrame, low: Column, high: Column) -> DataFrame:
    """Readings from the number and the sum of the scores of each interval."""
    mean = F.col("total").cast("double") / F.col("total_events")
    raw_score = measures.tension_raw(mean, F.col("total_events"))
    return partials.select("timestamp", "total_events", measures.normalize_0_10(raw_score, low, high).alias("tension_score"))


def tension_readings(raw: DataFrame, low: Column, high: Column, reading: str = READING) -> DataFrame:
    """Tension score per reading interval, scaled with the percentiles of the history.

    Filters are those of the daily index except the country pattern, which belongs to another
    themes column than the one in live files.
    """
    partials = _counted(drop_repeated(raw), reading).groupBy("timestamp").agg(
        F.count("*").alias("total_events"), F.sum(F.col("neg_score").cast(_EXACT)).alias("total"))
    return _scores(partials, low, high)


# --- Stored tables

_ROW = ", ".join(f"{c} string" for c in _FIELDS) + ", time timestamp"
_PARTIAL = f"timestamp timestamp, total_events bigint, total {_EXACT.replace('28', '38')}"
_BAD = "time timestamp, file string, reason string, line string"


def _added_up(partials: DataFrame) -> DataFrame:
    summed = partials.groupBy("timestamp").agg(F.sum("total_events").alias("total_events"), F.sum("total").alias("total"))
    return summed.where("total_events <> 0").select("timestamp", "total_events", F.col("total").cast("decimal(38,16)").alias("total"))


KINDS = {
    "rows": Kind(_ROW, "time", _first_of_each, ("url", "time")),
    "readings": Kind(_PARTIAL, "timestamp", _added_up),
    "quarantine": Kind(_BAD, "time", lambda rows: rows),
}


def live_store(spark: SparkSession, out: str, fan: int = FAN) -> Store:
    return Store(spark, out, KINDS, fan)


def _changes(arrived: DataFrame, known: DataFrame) -> DataFrame:
    """Rows that are new or smaller than the stored one of their article, with that one's other fields as replaced.

    arrived may hold rows of an article that differ: the smallest is found in the same pass, so rows are shuffled once.
    """
    both = arrived.select("url", "time", F.struct(*_REST).alias("new"), F.lit(None).cast(_struct()).alias("old")).unionByName(
        known.select("url", "time", F.lit(None).cast(_struct()).alias("new"), F.struct(*_REST).alias("old")))
    best = both.groupBy("url", "time").agg(F.min("new").alias("new"), F.min("old").alias("replaced"))
    changed = best.where(F.col("new").isNotNull() & (F.col("replaced").isNull() | (F.col("new") < F.col("replaced"))))
    return changed.select(*(F.col("url") if c == "url" else F.col(f"new.{c}") for c in _FIELDS), "time", "replaced")


def _struct() -> str:
    return f"struct<{', '.join(f'{c}: string' for c in _REST)}>"


def _taken_back(changed: DataFrame) -> DataFrame:
    """The stored rows that changes replace."""
    return changed.where("replaced IS NOT NULL").select(
        *(F.col("url") if c == "url" else F.col(f"replaced.{c}") for c in _FIELDS), "time")


def _newest(rows: DataFrame, latest: list[list], n: int) -> list[list]:
    """The newest articles of rows and of those found before, as the manifest has them: time in microseconds, title, source, category.

    Titles are made for the latest rows only. If they do not hold n articles, more rows are taken, and all of them in the end.
    """
    spark, wide = rows.sparkSession, TITLED * n
    while True:
        last = rows.select("time").orderBy(F.col("time").desc()).limit(wide)
        edge = last.agg(F.count("*").alias("n"), F.min(F.unix_micros("time")).alias("first")).first()
        whole, recent = edge["n"] < wide, F.unix_micros("time") >= F.lit(edge["first"])
        near = rows if whole else rows.where(recent)
        articles = archive.live_articles(near).select("time", "title", "source", "category")
        if latest:
            articles = articles.unionByName(_latest_frame(spark, latest))
        found = archive.latest_news(articles, n).select(F.unix_micros("time").alias("time"), "title", "source", "category").collect()
        if whole or (len(found) == n and min(r["time"] for r in found) >= edge["first"]):
            return [list(r) for r in found]
        wide *= WIDER


def _latest_frame(spark: SparkSession, rows: list[list]) -> DataFrame:
    frame = spark.createDataFrame([tuple(r) for r in rows], "micros bigint, title string, source string, category string")
    return frame.select(F.timestamp_micros("micros").alias("time"), "title", "source", "category")


def update_tables(batch: DataFrame, batch_id: int, out: str, percentiles: str, n: int = NEWEST, fan: int = FAN,
                  bad: DataFrame | None = None, extent: Row | None = None) -> Manifest:
    """One batch: rows that are new, what they change in the readings, the newest articles, lines that are none; one commit.

    batch: fields of live lines; bad: lines for the side table (time, file, reason, line); extent: their number and range of times, as
    start measures it. A batch that is run again starts from the manifest of the one before and gives the same tables.
    """
    spark = batch.sparkSession
    store = live_store(spark, out, fan)
    before = store.manifest(before=batch_id)
    name = f"batch-{batch_id}"
    low, high = spark.read.parquet(percentiles).select("p1", "p99").first()
    tables, facts = dict(before.tables), {**before.facts, "p1": low, "p99": high}
    timed = cleaning.drop_bad_time(batch.select(*_FIELDS))
    if extent is None:
        extent = timed.agg(*_extent(F.col("time"))).first()
    if extent["first"] is not None:
        keys = timed.select("url", "time").distinct()
        holding = store.holding("rows", before, keys, extent["first"], extent["last"])
        near = F.col("time").between(F.timestamp_micros(F.lit(extent["first"])), F.timestamp_micros(F.lit(extent["last"])))
        replaced = Observation()
        changed = _changes(timed, store.read("rows", holding).where(near)).persist()
        watched = changed.observe(replaced, F.count("replaced").alias("n"))
        rows = store.write("rows", watched.drop("replaced"), name)
        taken_back = _taken_back(changed)
        signed = _counted(changed.drop("replaced")).withColumn("sign", F.lit(1)).unionByName(
            _counted(taken_back).withColumn("sign", F.lit(-1)))
        deltas = signed.groupBy("timestamp").agg(
            F.sum("sign").alias("total_events"),
            F.sum((F.col("neg_score").cast(_EXACT) * F.col("sign")).cast("decimal(28,16)")).cast("decimal(38,16)").alias("total"))
        tables["readings"] = store.added("readings", before, store.write("readings", deltas, name))
        tables["rows"] = store.added("rows", before, rows)
        new, latest = changed.drop("replaced"), facts.get("latest", [])
        if replaced.get["n"] and _lost(taken_back, latest):
            # What follows the last of the newest is in the stored rows only.
            new, latest = store.current("rows", Manifest(batch_id, tables)), []
        facts["latest"] = _newest(new, latest, n)
        changed.unpersist()
    if bad is not None:
        if extent["bad"]:
            tables["quarantine"] = store.added("quarantine", before, store.write("quarantine", bad, name))
        counts = facts.get("counts", NO_LINES)
        facts["counts"] = {"lines": counts["lines"] + extent["lines"], "kept": counts["kept"] + extent["lines"] - extent["bad"],
                           "quarantined": counts["quarantined"] + extent["bad"]}
    manifest = Manifest(batch_id, tables, facts)
    store.commit(manifest)
    return manifest


def _extent(time: Column) -> list[Column]:
    micros = F.unix_micros(time)
    return [F.min(micros).alias("first"), F.max(micros).alias("last")]


def _lost(taken_back: DataFrame, latest: list[list]) -> bool:
    """Whether an article that is taken back is among the newest."""
    if not latest:
        return False
    last = min(r[0] for r in latest)
    return not archive.live_articles(taken_back.where(F.unix_micros("time") >= last)).isEmpty()


def start(
    spark: SparkSession, folder: str, percentiles: str, out: str, checkpoint: str, once: bool = False,
    files_per_batch: int = 1000, n: int = NEWEST, fan: int = FAN,
) -> StreamingQuery:
    """The live stream: articles, newest articles and tension readings from one pass over the files.

    percentiles is read again in every batch. Lines that are none go to a side table, with their file and the reason.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = checked_live_lines(batch).persist()
        good = lines.where("reason IS NULL").select(*_FIELDS)
        bad = lines.where("reason IS NOT NULL").select(
            F.lit(datetime.fromtimestamp(0, UTC)).alias("time"), "file", "reason", F.col("value").alias("line"))
        time = F.when(F.col("reason").isNull(), calendar.news_time(F.col("date")))
        extent = lines.agg(F.count("*").alias("lines"), F.count("reason").alias("bad"), *_extent(time)).first()
        update_tables(good, batch_id, out, percentiles, n, fan, bad, extent)
        lines.unpersist()

    writer = read_live_lines(spark, folder, files_per_batch).writeStream.foreachBatch(write)
    trigger = {"availableNow": True} if once else {"processingTime": READING}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def current_rows(spark: SparkSession, out: str) -> DataFrame:
    """Stored rows, one per article."""
    return live_store(spark, out).current("rows").select(*_FIELDS, "time")


def current_articles(spark: SparkSession, out: str) -> DataFrame:
    return archive.live_articles(current_rows(spark, out))


def current_readings(spark: SparkSession, out: str) -> DataFrame:
    """All readings, scaled with the percentiles of the last batch."""
    store = live_store(spark, out)
    manifest = store.manifest()
    low, high = (F.lit(manifest.facts.get(p)).cast("double") for p in ("p1", "p99"))
    return _scores(store.current("readings", manifest), low, high)


def current_latest(spark: SparkSession, out: str) -> DataFrame:
    """The newest articles."""
    return _latest_frame(spark, live_store(spark, out).manifest().facts.get("latest", []))


def quarantined(spark: SparkSession, out: str) -> DataFrame:
    """Lines that are no articles: file, reason, line."""
    return live_store(spark, out).current("quarantine").select("file", "reason", "line")


def line_counts(spark: SparkSession, out: str) -> dict[str, int]:
    """Lines read, kept and put aside by all batches."""
    return live_store(spark, out).manifest().facts.get("counts", NO_LINES)
