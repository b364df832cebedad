"""Tables that grow by batches: immutable segments, and a manifest that says which of them count.

A batch writes its own segments and then one manifest, which is the commit: readers see all tables of a batch or none, and a
batch that dies or is run again starts from the manifest before it. Segments of one level are merged into one of the next when there
are FAN of them, so a table has few segments however many batches came. A manifest names its segments with the range of their times
and a filter on their keys, so no folder is listed and no segment is read that holds nothing of interest.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Segments of a level that are merged into one.
FAN = 8
#: Manifests that are kept. The one before the last is what a batch that is run again starts from.
KEPT_MANIFESTS = 2
#: Bits of a key filter for each row, and bits that each key sets: about one foreign key in a million passes.
BITS_PER_ROW, HASHES = 32, 7
_PART_BITS = 32_768  # of one row of a filter, as the bitmap functions have it


@dataclass(frozen=True)
class Segment:
    """A folder of rows: its level, number of rows, range of times (microseconds), and the parts of its key filter (0: none)."""

    name: str
    level: int
    rows: int
    first: int
    last: int
    parts: int = 0


@dataclass(frozen=True)
class Manifest:
    """The segments of each table after a batch, and small facts that go with them."""

    batch: int = -1
    tables: dict[str, tuple[Segment, ...]] = field(default_factory=dict)
    facts: dict[str, Any] = field(default_factory=dict)

    def segments(self, table: str) -> tuple[Segment, ...]:
        return self.tables.get(table, ())


@dataclass(frozen=True)
class Kind:
    """What a table is made of: columns, the one that orders its segments, key (for a filter), and how rows of several segments become one."""

    schema: str
    time: str
    merge: Callable[[DataFrame], DataFrame]
    key: tuple[str, ...] = ()


class Store:
    def __init__(self, spark: SparkSession, path: str, kinds: dict[str, Kind], fan: int = FAN):
        self.spark, self.path, self.kinds, self.fan = spark, path.rstrip("/"), kinds, fan

    # --- Manifests

    def manifest(self, before: int | None = None) -> Manifest:
        """The last manifest, or the last one of a batch before some number; an empty one if there is none."""
        found = [n for n in self._batches() if before is None or n < before]
        if not found:
            return Manifest()
        stream = self._system(self._manifest_path(max(found))).open(self._path(self._manifest_path(max(found))))
        read = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return Manifest(read["batch"], {t: tuple(Segment(**s) for s in found) for t, found in read["tables"].items()}, read["facts"])

    def commit(self, manifest: Manifest) -> None:
        """Make a manifest the last one, then remove what no kept manifest names."""
        target = self._manifest_path(manifest.batch)
        system, draft = self._system(target), self._path(f"{self.path}/manifests/_draft-{manifest.batch}")
        text = json.dumps({"batch": manifest.batch, "tables": {t: [asdict(s) for s in found] for t, found in manifest.tables.items()},
                           "facts": manifest.facts})
        out = system.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        # A batch that is run again replaces its manifest; until the new name is there, the batch before is the last.
        system.delete(self._path(target), False)
        system.rename(draft, self._path(target))
        self._clean(manifest)

    def _clean(self, last: Manifest) -> None:
        batches = sorted(self._batches())
        old, kept = batches[:-KEPT_MANIFESTS], batches[-KEPT_MANIFESTS:]
        named = {s.name for n in kept for found in self.manifest(n + 1).tables.values() for s in found}
        system = self._system(self.path)
        for n in old:
            self._remove(s for found in self.manifest(n + 1).tables.values() for s in found if s.name not in named)
            system.delete(self._path(self._manifest_path(n)), False)

    def _remove(self, segments: Iterable[Segment]) -> None:
        for segment in segments:
            for folder in (segment.name, f"filters/{segment.name}"):
                self._system(self.path).delete(self._path(f"{self.path}/{folder}"), True)

    def _batches(self) -> list[int]:
        folder = self._path(f"{self.path}/manifests")
        system = self._system(self.path)
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _manifest_path(self, batch: int) -> str:
        return f"{self.path}/manifests/{batch}.json"

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    # --- Segments

    def read(self, table: str, segments: tuple[Segment, ...] | list[Segment]) -> DataFrame:
        """The rows of segments as they stand, not merged."""
        schema = self.kinds[table].schema
        if not segments:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{s.name}" for s in segments))

    def current(self, table: str, manifest: Manifest | None = None) -> DataFrame:
        """The rows of a table after the last batch."""
        manifest = manifest or self.manifest()
        return self.kinds[table].merge(self.read(table, manifest.segments(table)))

    def write(self, table: str, rows: DataFrame, name: str, level: int = 0) -> Segment | None:
        """A segment of rows; None if there are none. Merged ones get a filter on their keys, single batches are small."""
        kind = self.kinds[table]
        seen, path = Observation(), f"{self.path}/{table}/{name}"
        micros = F.unix_micros(F.col(kind.time).cast("timestamp"))
        watched = rows.observe(seen, F.count("*").alias("n"), F.min(micros).alias("first"), F.max(micros).alias("last"))
        watched.write.mode("overwrite").parquet(path)
        found = seen.get
        if not found["n"]:
            return None
        segment = Segment(f"{table}/{name}", level, found["n"], found["first"] or 0, found["last"] or 0)
        if kind.key and level:
            parts = 1 << max(0, (found["n"] * BITS_PER_ROW - 1) // _PART_BITS).bit_length()
            segment = replace(segment, parts=parts)
            stored = self.spark.read.schema(kind.schema).parquet(path)
            bits = stored.select(F.explode(_bits(kind.key)).alias("bit")).select(
                _part(F.lit(parts)).alias("part"), F.bitmap_bit_position("bit").alias("at"))
            bits.groupBy("part").agg(F.bitmap_construct_agg("at").alias("marks")).write.mode("overwrite").parquet(
                f"{self.path}/filters/{segment.name}")
        return segment

    def holding(self, table: str, manifest: Manifest, rows: DataFrame, first: int, last: int) -> list[Segment]:
        """The segments that may hold keys of the rows, by the range of their times and their key filters."""
        kind = self.kinds[table]
        found = [s for s in manifest.segments(table) if s.last >= first and s.first <= last]
        near = [s for s in found if s.parts]
        if not near:
            return found
        marks = self.spark.read.schema("part bigint, marks binary").option("recursiveFileLookup", "true").parquet(
            *(f"{self.path}/filters/{s.name}" for s in near))
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/filters/(.*)/[^/]*$", 1)
        marks = marks.select(folder.alias("of"), F.col("part").alias("p"), "marks")
        # Few segments are near, so each key is tested against each of them.
        segments = F.array(*(F.struct(F.lit(s.name).alias("name"), F.lit(s.parts).alias("parts")) for s in near))
        tests = rows.select(F.xxhash64(*kind.key).alias("key"), _bits(kind.key).alias("bits")).select(
            "key", "bits", F.explode(segments).alias("s")).select("key", "s", F.explode("bits").alias("bit"))
        tests = tests.select("key", F.col("s.name").alias("name"), _part(F.col("s.parts")).alias("part"),
                             F.bitmap_bit_position("bit").alias("at"))
        hit = tests.join(marks, (F.col("name") == F.col("of")) & (F.col("part") == F.col("p")))
        octet = F.conv(F.hex(F.substring("marks", (F.shiftright("at", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = hit.where(F.getbit(octet, (F.col("at") % 8).cast("int")) == 1)
        whole = hit.groupBy("name", "key").agg(F.count("*").alias("n")).where(F.col("n") == HASHES)
        names = {r["name"] for r in whole.select("name").distinct().collect()}
        return [s for s in found if not s.parts or s.name in names]

    def added(self, table: str, manifest: Manifest, segment: Segment | None) -> tuple[Segment, ...]:
        """The segments of a table with a new one; full levels are merged into a segment of the next."""
        found = [*manifest.segments(table), *([segment] if segment else [])]
        named, level = set(manifest.segments(table)), 0
        while True:
            full = [s for s in found if s.level == level]
            if len(full) < self.fan:
                if not any(s.level > level for s in found):
                    return tuple(found)
            else:
                rows = self.kinds[table].merge(self.read(table, full))
                merged = self.write(table, rows, f"merged-{segment.name.split('/')[-1]}-{level + 1}", level + 1)
                found = [s for s in found if s.level != level] + ([merged] if merged else [])
                # No manifest will name what was made and merged in one batch.
                self._remove(s for s in full if s not in named)
            level += 1


def _bits(key: tuple[str, ...]) -> Column:
    """Positive numbers that stand for a key in filters of any size."""
    wide = F.lit((1 << 62) - 1)
    return F.array(*(F.xxhash64(F.lit(seed), *key).bitwiseAND(wide) + 1 for seed in range(HASHES)))


def _part(parts: Column) -> Column:
    """Row of a filter that a bit falls into; the bit itself is its position in that row."""
    return F.pmod(F.bitmap_bucket_number("bit"), parts.cast("bigint"))
