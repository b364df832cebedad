"""Times the headline queries on the sample tables and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_QUERIES (comma list) a selection.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from stormglass.catalog import QUERIES  # noqa: E402
from stormglass.catalog.registry import inputs  # noqa: E402
from stormglass.operators import themes  # noqa: E402
from stormglass.session import SETTINGS, scratch_path  # noqa: E402
from stormglass.sources.news import ingest_raw_news, scan_raw_news  # noqa: E402

HEADLINE = [
    "ingest_raw_news", "ingest", "tension_index", "spike_events", "event_window", "ticker_summary",
    "portfolio_risk", "spike_news", "spike_news_from_store", "spike_labels", "supporting_news",
    "event_explorer", "risk_snapshot", "live_articles", "stream_tension_readings",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("stormglass-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def ingest_rate(spark: SparkSession, folder: str) -> tuple[float, float]:
    """Megabytes of raw text per second, from files to classified Parquet, and gigabytes read. Lines are as long as those
    of the archive, most of it theme lists, and one in 450 is kept."""
    raw = inputs(spark, folder).raw_news_folder(filler=3300, times=2, kept_every=450)
    size = folder_bytes(spark, raw)
    start = time.perf_counter()
    lines = scan_raw_news(spark, raw)
    found = ingest_raw_news(lines, themes.learn(lines, themes.BATCH))
    found.write.parquet(scratch_path(spark, "rate"))
    return round(size / 1e6 / (time.perf_counter() - start), 2), round(size / 1e9, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    # Inputs that the queries share are staged first and timed apart; this also gets the JVM going.
    start = time.perf_counter()
    found = inputs(spark, folder)
    for frame in (found.news, found.live):
        frame.write.format("noop").mode("overwrite").save()
    built = round(time.perf_counter() - start, 3)
    seconds = {name: run(spark, name, folder) for name in names}
    rate, size = ingest_rate(spark, folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "inputs_sec": built, "ingest_mb_per_sec": rate, "ingest_gb": size,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
