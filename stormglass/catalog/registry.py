"""Registry of checked queries: a name, its Spark form, and its DuckDB form if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormglass.catalog.relations import with_relations
from stormglass.sources.derived import Derived

_INPUTS: dict[tuple, Derived] = {}


def _files(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what is in a folder: a table that changes is another input."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def inputs(spark: SparkSession, folder: str) -> Derived:
    """The derived inputs of a folder; what they stage is written once in a session and used by all queries."""
    key = (spark.sparkContext.applicationId, folder, _files(spark, folder))
    if key not in _INPUTS:
        _INPUTS[key] = Derived(spark, folder)
    return _INPUTS[key]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of Derived inputs under a name, with its SQL."""

    def register(build: Callable[[Derived], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(inputs(spark, folder))
        if sql is not None:
            ORACLES[name] = with_relations(sql)
        return build

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Sums of doubles depend on order in the last digits, so both sides compare six places."""
    return df.withColumns({c: F.round(c, places) for c in columns})
