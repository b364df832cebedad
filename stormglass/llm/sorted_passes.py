"""Near-duplicate vectors by sorted projection passes.

In each pass the vectors are ordered by the concatenated signs of random projections, and each is compared
with a bounded number of neighbours in that order. Pairs found in any pass are united. As a window sees
only part of a large group, the links inside each component are then counted in full, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormglass.llm import vectors
from stormglass.llm.components import connected
from stormglass.llm.scratch import Scratch

#: Passes, signs of a key, neighbours on either side, positions compared by a task at a time.
PASSES, SIGNS, WINDOW, BLOCK_ROWS = 16, 60, 32, 1024
#: Members of a component that are compared with as many others at a time.
CELL_ROWS = 512
#: More than matrix products can differ from sums in order.
_SLACK = 1e-9


def _keys(classes: DataFrame, passes: int) -> DataFrame:
    """A row per vector and pass, with the signs of the pass packed into a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = 1 << np.arange(SIGNS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                rows = vectors.matrix(part.column("embedding"))
                for number in range(passes):
                    directions = np.random.default_rng([3, number, int(size)]).standard_normal((size, SIGNS))
                    key = ((rows @ directions) > 0) @ powers
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), number, np.int32)), pa.array(key), *part.columns],
                        names=["pass", "key", *part.schema.names])

    columns = classes.select("cls", "label", "size", "embedding")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema)
    return columns.mapInArrow(run, f"pass int, key bigint, {fields}")


def _placed(keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with their position in the order of their pass, label and length.

    A range sort spreads the order over tasks, equal keys included; positions are those within a file plus
    the rows of the files before.
    """
    order = ["pass", "label", "size", "key", "cls"]
    placed = scratch.stage(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()), "sorted")
    group = ["pass", "label", "size"]
    placed = placed.withColumn("file", F.shiftright("at", 33))
    offsets = (
        placed.groupBy("file", *group).agg(F.count("*").alias("n"), F.min("at").alias("first"))
        .withColumn("before", F.sum("n").over(
            Window.partitionBy(*group).orderBy("file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
        .drop("n"))
    return placed.join(offsets, ["file", *group]).withColumn("position", F.col("before") + F.col("at") - F.col("first"))


def _units(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = vectors.matrix(table["embedding"])
    norms = vectors.norms(rows)
    return rows, norms, rows / norms[:, None]


def _linked(left, right, least: float, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the allowed pairs with cosine of at least ``least``, those near the border summed in order."""
    a, b = np.nonzero((left[2] @ right[2].T >= least - _SLACK) & allowed)
    exact = vectors.dots(left[0][a], right[0][b]) / (left[1][a] * right[1][b])
    return a[exact >= least], b[exact >= least]


def _forest(numbers: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few of the pairs that unite the same vectors."""
    parent = np.arange(len(numbers))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a, b, strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    x, y = np.array(kept, np.int64).reshape(-1, 2).T
    return numbers[x], numbers[y]


def _pass_links(placed: DataFrame, least: float, window: int) -> DataFrame:
    """(a, b) united by the windows, compared in blocks that begin with the last rows of the block before."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("position")
        position, own = table["position"].to_numpy(), table["own"].to_numpy(zero_copy_only=False)
        units = _units(table)
        apart = position[None, :] - position[:, None]
        allowed = (apart > 0) & (apart <= window) & own[None, :]
        a, b = _forest(table["cls"].to_numpy(), *_linked(units, units, least, allowed))
        return pa.table({"a": a, "b": b})

    block = F.floor(F.col("position") / BLOCK_ROWS)
    over = F.col("position") % BLOCK_ROWS >= BLOCK_ROWS - window
    copies = F.when(over, F.array(block, block + 1)).otherwise(F.array(block))
    rows = placed.select("pass", "label", "size", "cls", "embedding", "position", F.explode(copies).alias("block"))
    rows = rows.withColumn("own", F.col("block") == block)
    return rows.groupBy("pass", "label", "size", "block").applyInArrow(compare, "a bigint, b bigint")


def _inner_links(members: DataFrame, least: float) -> DataFrame:
    """(cls, others): rows linked to each vector by other vectors of its component, all of them compared.

    members: component, parts, cls, n, embedding. A component is cut into parts by hash, and each pair of
    parts is a task's work; only counts leave it.
    """

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        part, low, high = (table[c].to_numpy() for c in ("part", "low", "high"))
        first = table.filter(pa.array(part == low))
        second = table.filter(pa.array(part == high))
        left, right = _units(first), _units(second)
        a_cls, b_cls = first["cls"].to_numpy(), second["cls"].to_numpy()
        a, b = _linked(left, right, least, a_cls[:, None] != b_cls[None, :])
        found = np.bincount(a, second["n"].to_numpy()[b], len(a_cls))
        names, counts = [a_cls], [found]
        if low[0] != high[0]:
            names.append(b_cls)
            counts.append(np.bincount(b, first["n"].to_numpy()[a], len(b_cls)))
        return pa.table({"cls": np.concatenate(names), "others": np.concatenate(counts).astype(np.int64)})

    rows = (
        members.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")))
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumn("low", F.least("part", "with")).withColumn("high", F.greatest("part", "with"))
        .select("component", "low", "high", "part", "cls", "n", "embedding"))
    found = rows.groupBy("component", "low", "high").applyInArrow(compare, "cls bigint, others bigint")
    return found.groupBy("cls").agg(F.sum("others").alias("others"))


def near_vectors(embeddings: DataFrame, scratch: Scratch, least: float = 0.98, passes: int = PASSES,
                 window: int = WINDOW) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    embeddings: vec_id, embedding, label; other columns are ignored. Equal vectors of a label are one vector
    with a count until the end, so copies cost no comparisons. Vectors that are null, zero or not finite, have
    no label or no vec_id link with nothing and are components of their own; a row without vec_id has no
    component_id and is kept. Rows that repeat a vec_id are vectors of their own.
    """
    hashes = [F.xxhash64(F.lit(seed), "embedding") for seed in (1, 2)]
    able = vectors.usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = embeddings.select("vec_id", "label", "embedding", F.size("embedding").alias("size"), able.alias("able"),
                             hashes[0].alias("h1"), hashes[1].alias("h2"))
    classes = scratch.stage(
        rows.where("able").groupBy("label", "size", "h1", "h2")
        .agg(F.any_value("embedding").alias("embedding"), F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("cls", F.monotonically_increasing_id()), "classes")
    found = scratch.stage(_pass_links(_placed(_keys(classes, passes), scratch), least, window), "links")
    members = scratch.stage(connected(found, scratch), "members")
    sizes = members.groupBy("component").agg(F.count("*").alias("m"))
    sizes = scratch.stage(sizes.select("component", F.ceil(F.col("m") / CELL_ROWS).cast("long").alias("parts")), "sizes")
    located = scratch.stage(
        classes.join(members, F.col("cls") == F.col("vertex")).drop("vertex")
        .join(sizes, "component").select("component", "parts", "cls", "least", "n", "embedding"), "located")
    others = _inner_links(located, least)
    names = scratch.stage(located.groupBy("component").agg(F.min("least").alias("component_id")), "names")
    linked = (
        located.select("cls", "component").join(others, "cls").join(names, "component")
        .select(F.col("cls").alias("of"), "others", "component_id"))
    figures = scratch.stage(
        classes.join(linked, F.col("cls") == F.col("of"), "left").select(
            F.col("label").alias("c_label"), F.col("h1").alias("c1"), F.col("h2").alias("c2"),
            (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component_id", "least").alias("component_id")), "figures")
    scratch.drop("figures")
    same = (F.col("label") == F.col("c_label")) & (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))
    result = rows.select("vec_id", "label", "able", "h1", "h2").join(figures, F.col("able") & same, "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
