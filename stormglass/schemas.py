"""Explicit schemas: nothing is inferred from the data."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


FILTERED_NEWS = _strings("record_id", "date", "source", "url", "themes", "tone", "category")

# Fields of a raw news line that are used, by 1-based position in the file.
RAW_NEWS_FIELDS = {1: "record_id", 2: "date", 4: "source", 5: "url", 7: "themes", 16: "tone"}
RAW_NEWS_WIDTH = 27

# Fields of a live file by 0-based position; the tone is needed for a live score.
LIVE_NEWS_FIELDS = {1: "date", 3: "source", 4: "url", 7: "themes", 15: "tone"}


def raw_news() -> T.StructType:
    return _strings(
        *(RAW_NEWS_FIELDS.get(i, f"field_{i}") for i in range(1, RAW_NEWS_WIDTH + 1))
    )


PORTFOLIO = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("weight", T.DoubleType()),
])

SECTORS = T.StructType([
    T.StructField("sector", T.StringType()),
    T.StructField("ticker", T.StringType()),
])

FUNDS = _strings("sector", "etf")

LABELS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("label", T.StringType()),
])

LIVE_TEXT = T.StructType([T.StructField("value", T.StringType())])
