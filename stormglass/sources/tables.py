"""Parquet tables between jobs, dimension tables, and row-count reports."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from stormglass import fixed_values as V
from stormglass import schemas
from stormglass.operators.reactions import prices_wide_to_long


def write_table(df: DataFrame, path: str) -> int:
    """Overwrite a table; the number of rows is counted during the write, not by a second run."""
    seen = Observation()
    replace_table(df.observe(seen, F.count("*").alias("rows")), path)
    return seen.get["rows"]


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite a table with a new version that is written beside it: until it is complete, the old one can be read,
    and a job that fails, or reads the table it writes, leaves the old one as it is."""
    spark, path = df.sparkSession, path.rstrip("/")
    draft = f"{path}.draft-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.parquet(draft)
        system.delete(hadoop(path), True)
        if not system.rename(hadoop(draft), hadoop(path)):
            raise OSError(f"{draft} could not be renamed to {path}")
    finally:
        system.delete(hadoop(draft), True)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows. Many tasks write at once; only a finished job becomes visible."""
    df.write.mode("append").parquet(path)


def write_sorted(df: DataFrame, path: str, *columns: str) -> None:
    """Overwrite with rows in global order: range partitions, each sorted."""
    replace_table(df.repartitionByRange(*columns).sortWithinPartitions(*columns), path)


def scan_prices(spark: SparkSession, *paths: str) -> DataFrame:
    """Wide price files whose columns differ by year, merged by name."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def scan_long_prices(
    spark: SparkSession, *paths: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Prices by day and ticker, of a range of days if given: that filters the stored times, which the scan skips by."""
    wide = scan_prices(spark, *paths)
    if first is not None and last is not None:
        wide = wide.filter(F.col("Date").between(_nanoseconds(first), _nanoseconds(last + timedelta(days=1)) - 1))
    return prices_wide_to_long(wide)


def _nanoseconds(day: date) -> int:
    return (day - date(1970, 1, 1)).days * 86_400_000_000_000


def literal(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """Rows as a local relation: unlike an RDD its size is known, so joins can broadcast it."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    table = pa.table(
        [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)],
        names=schema.names,
    )
    return spark.createDataFrame(table, schema)


def literal_portfolio(spark: SparkSession, holdings=V.SAMPLE_PORTFOLIO) -> DataFrame:
    return literal(spark, list(holdings), schemas.PORTFOLIO)


def sector_tickers(spark: SparkSession, mapping=V.SECTOR_TICKERS) -> DataFrame:
    rows = [(sector, ticker) for sector, tickers in mapping.items() for ticker in tickers]
    return literal(spark, rows, schemas.SECTORS)


def sector_funds(spark: SparkSession, funds=V.SECTOR_FUNDS) -> DataFrame:
    return literal(spark, list(funds.items()), schemas.FUNDS)


def known_events(spark: SparkSession, labels=V.KNOWN_EVENTS) -> DataFrame:
    rows = [(date.fromisoformat(day), label) for day, label in labels.items()]
    return literal(spark, rows, schemas.LABELS)
