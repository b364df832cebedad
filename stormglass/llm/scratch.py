"""Intermediate tables in the shared folder, dropped as soon as their reader is done."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stormglass.session import scratch_path

#: Whether Spark removes the shuffle files of a query when it ends, rather than when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Scratch:
    """Tables that one operator writes and reads again.

    ``stage`` cuts the lineage: what follows reads committed files in the folder that the cluster
    names in spark.checkpoint.dir, so a lost executor costs its running tasks only. The shuffle files behind a
    table go when it is written, since nothing reads them again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._made: list[tuple[str, str]] = []

    def path(self, label: str) -> str:
        folder = scratch_path(self.spark, label)
        self._made.append((label, folder))
        return folder

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        folder = self.path(label)
        with _shuffles_removed(self.spark):
            df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def drop(self, *keep: str) -> None:
        """Delete all tables but the last one of each label to keep, which a result still reads."""
        last = {label: folder for label, folder in self._made if label in keep}
        for label, folder in self._made:
            if last.get(label) != folder:
                self._delete(folder)
        self._made = list(last.items())

    def discard(self, *labels: str) -> None:
        """Delete all tables of some labels, which nothing reads any more."""
        for label, folder in self._made:
            if label in labels:
                self._delete(folder)
        self._made = [(label, folder) for label, folder in self._made if label not in labels]

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
