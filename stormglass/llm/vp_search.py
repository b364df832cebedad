"""Nearest neighbours by vantage-point trees: one tree per shard, queries in blocks against all shards.

Distances are those between unit vectors, which order like cosines and obey the triangle inequality. A
branch is left out if factor times the distance of the k-th best, around the query, does not reach it: at
factor 1 nothing nearer can be lost, below 1 more is left out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormglass.llm import vectors
from stormglass.llm.scratch import Scratch

#: Vectors of a shard, of a leaf, and queries of a block: what one task holds at a time.
SHARD_ROWS, LEAF_ROWS, BLOCK_QUERIES = 8192, 128, 1024
#: More than rounding can move a distance by.
_SLACK = 1e-7

_HITS = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                   ("row", pa.int64()), ("score", pa.float64())])


def build_tree(units: np.ndarray, members: np.ndarray, leaf_rows: int = LEAF_ROWS):
    """A leaf is an array of rows; a node a vantage row and two children, each (least, most distance, subtree)."""
    if len(members) <= leaf_rows:
        return members
    # Any member serves as vantage point; the middle one makes the tree a function of the input.
    at = len(members) // 2
    vantage, rest = members[at], np.delete(members, at)
    far = _distances(units[rest] @ units[vantage])
    order = np.argsort(far, kind="stable")
    half = len(order) // 2
    parts = [(far[part], rest[part]) for part in (order[:half], order[half:])]
    return vantage, [(d.min(), d.max(), build_tree(units, m, leaf_rows)) for d, m in parts]


def _distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosines))


class Search:
    """Best rows of a tree for a block of queries; scores are exact, ties go to smaller numbers."""

    def __init__(self, tree, rows: np.ndarray, numbers: np.ndarray, ids: np.ndarray, queries: np.ndarray,
                 own: np.ndarray, k: int, factor: float):
        self.rows, self.norms = rows, vectors.norms(rows)
        self.row_units = rows / self.norms[:, None]
        self.numbers, self.ids, self.k, self.factor = numbers, ids, k, factor
        self.queries, self.own, self.query_norms = queries, own, vectors.norms(queries)
        self.units = queries / self.query_norms[:, None]
        self.score = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), -1)
        self._visit(tree, np.arange(len(queries)))

    def _offer(self, which: np.ndarray, members: np.ndarray, cosines: np.ndarray) -> None:
        """Take members into the best of the queries, if they belong there."""
        near = (cosines >= self.score[which, -1][:, None] - _SLACK) & (
            self.ids[members][None, :] != self.own[which][:, None])
        q, m = np.nonzero(near)
        if not len(q):
            return
        query, member = which[q], members[m]
        exact = vectors.dots(self.queries[query], self.rows[member])
        exact /= self.query_norms[query] * self.norms[member]
        touched = np.unique(query)
        old_q = np.repeat(touched, self.k)
        query = np.concatenate([old_q, query])
        member = np.concatenate([self.found[touched].ravel(), member])
        exact = np.concatenate([self.score[touched].ravel(), exact])
        order = np.lexsort((self.ids[member], self.numbers[member], -exact, query))
        query, member, exact = query[order], member[order], exact[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        self.score[query[kept], place[kept]] = exact[kept]
        self.found[query[kept], place[kept]] = member[kept]

    def _visit(self, node, which: np.ndarray) -> None:
        if not len(which):
            return
        if isinstance(node, np.ndarray):
            self._offer(which, node, self.units[which] @ self.row_units[node].T)
            return
        vantage, children = node
        cosines = self.units[which] @ self.row_units[vantage]
        self._offer(which, np.array([vantage]), cosines[:, None])
        far = _distances(cosines)
        first_inside = far <= children[0][1]
        # The likelier side first: what it finds narrows the other.
        for nearer, side in ((first_inside, 0), (~first_inside, 1), (first_inside, 1), (~first_inside, 0)):
            low, high, child = children[side]
            reach = self.factor * _distances(self.score[which, -1]) + _SLACK
            reach[np.isneginf(self.score[which, -1])] = np.inf
            self._visit(child, which[nearer & (far + reach >= low) & (far - reach <= high)])


def _shard_index(table: pa.Table) -> pa.Table:
    """The tree of a shard, in one row."""
    table = table.combine_chunks()
    rows = vectors.matrix(table["embedding"])
    ids = table["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
    units = rows / vectors.norms(rows)[:, None]
    content = (build_tree(units, np.arange(len(rows))), rows, ids, table["row"].to_numpy())
    return pa.table({"size": table["size"][:1], "shard": table["shard"][:1],
                     "tree": pa.array([pickle.dumps(content)], pa.large_binary()).cast(pa.binary())})


def nearest(embeddings: DataFrame, is_query, scratch: Scratch, k: int = 5, factor: float = 1.0,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k nearest rows of each query row: (query_id, rank, vec_id, score).

    embeddings: vec_id and embedding; other columns are ignored. is_query: condition on those columns. Rows are
    told apart by place, so of rows that repeat a vec_id each is a candidate of the others and each query row
    has its own ranking. Null, zero and non-finite vectors take no part; vectors of another length are no
    candidates; a null vec_id is never a query and comes last among ties. Fewer candidates than k give fewer rows,
    an empty table none.
    """
    valid = scratch.stage(
        embeddings.where(vectors.usable(F.col("embedding")))
        .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("size"),
                F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row")), "valid")
    total, asking = valid.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = -(-total // shard_rows) or 1, -(-asking // BLOCK_QUERIES) or 1
    index = scratch.stage(
        valid.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
        .groupBy("size", "shard").applyInArrow(_shard_index, "size int, shard bigint, tree binary"), "index")
    asked = (
        valid.where("asks").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .groupBy("size", "block").agg(F.collect_list(F.struct("row", "vec_id", "embedding")).alias("queries"))
        .select(F.col("size").alias("query_size"), "queries", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in range(batch.num_rows):
                tree, matrix, ids, rows = pickle.loads(batch.column("tree")[cell].as_py())
                queries = batch.column("queries")[cell].values
                own, numbers = queries.field("row").to_numpy(), queries.field("vec_id").to_numpy()
                hits = Search(tree, matrix, ids, rows, vectors.matrix(queries.field("embedding")), own, k, factor)
                q, place = np.nonzero(hits.found >= 0)
                member = hits.found[q, place]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own[q]), pa.array(numbers[q]),
                    pa.array(ids[member], mask=ids[member] == np.iinfo(np.int64).max), pa.array(rows[member]),
                    pa.array(hits.score[q, place])], schema=_HITS)

    scratch.drop("index", "valid")
    # Each block goes to all shards. Spark takes that side to be as large as the blocks and would send all copies over the driver.
    cells = index.join(asked.hint("merge"), (F.col("size") == F.col("query_size")) & (F.col("shard") == F.col("s")))
    hits = cells.select("tree", "queries").mapInArrow(
        search, "query_row bigint, query_id bigint, vec_id bigint, row bigint, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
