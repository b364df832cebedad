"""The prefix trie of conversations, with sums over subtrees by centroid decomposition.

A node stands for a sequence of first turns; its members are the conversations that begin with it. A node is named by
its smallest member and its depth, so the path from a node to the root is the front of one conversation, and
ancestors are found by a join on (conversation, depth) instead of a walk.

Sums over subtrees come from a centroid decomposition of the parent edges: each component is split at a node
whose removal leaves no part with more than half of its weight, the total below that node inside the component is added to the
nodes on the way from it to the component's top, and the parts go on by themselves. Large components are split by
joins, all at the same time; small ones are finished in tasks, many to a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormglass.llm.scratch import Scratch

#: Weight (turns of members) up to which a component is finished in one task.
SMALL = 1 << 16
#: Components above the limit are at most this many: the limit grows with the input instead of the table of centroids.
LARGE_COMPONENTS = 50_000
#: Turns of a conversation that one window of running hashes covers.
STRETCH = 4096
#: Conversations in a block of the list that is digested.
BLOCK = 8192


def _keyed(df: DataFrame, *names: str) -> DataFrame:
    """Columns computed anew under names that begin with k_, for joins that adaptive execution can split."""
    return df.select(*((F.col(n) + F.lit(0)).alias(f"k_{n}") for n in names), *(c for c in df.columns if c not in names))


def ordered_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, place, t1, t2, chars): the turns of each conversation, numbered from 1, with hashes of role and text.

    turns: conv_id, turn, role, text; other columns are ignored. Order is by turn (null first), then role, then text; null role or
    text is empty; rows without conv_id belong to no conversation. Range partitions hold the rows in order, and a
    conversation that spans several is numbered across them, so a long one is not in one task.
    """
    rows = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", *(F.xxhash64(F.lit(seed), "role", "text").alias(f"t{seed}") for seed in (1, 2)),
        F.length("text").cast("long").alias("chars"), F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("at"))
    dealt = scratch.stage(dealt, "dealt")
    runs = dealt.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    joined = dealt.join(_keyed(runs, "conv_id", "part"),
                        (F.col("conv_id") == F.col("k_conv_id")) & (F.col("part") == F.col("k_part")))
    return joined.select("conv_id", (F.col("at") + F.col("shift")).alias("place"), "t1", "t2", "chars")


def graft_heads(turns: DataFrame, heads: DataFrame) -> DataFrame:
    """The turns of conversations whose first turns are replaced by those of another one.

    turns: as ordered_turns gives them. heads: conv_id, base, head, one row per conversation: it gets the first ``head`` turns of base (all
    if base has fewer), then its own after its first ``head``. Bases may lack turns; conversations may end up without any.
    """
    most = heads.agg(F.max("head")).first()[0] or 0
    front = turns.where(F.col("place") <= most)
    own = _keyed(heads, "conv_id")
    taken = own.join(front, F.col("base") == F.col("conv_id")).where("place <= head").drop("conv_id").withColumnRenamed("k_conv_id", "conv_id")
    sizes = front.groupBy("conv_id").agg(F.count("*").alias("held")).select((F.col("conv_id") + F.lit(0)).alias("of"), "held")
    shift = own.join(sizes, F.col("base") == F.col("of"), "left").select(
        "k_conv_id", "head", F.least(F.coalesce("held", F.lit(0)), F.col("head")).alias("front"))
    rest = turns.join(shift, F.col("conv_id") == F.col("k_conv_id")).where("place > head")
    return taken.select("conv_id", "place", "t1", "t2", "chars").unionByName(
        rest.select("conv_id", (F.col("place") - F.col("head") + F.col("front")).alias("place"), "t1", "t2", "chars"))


def prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, chars): a row per conversation and number of first turns, 0 included.

    p1 and p2 name the sequence: exclusive or of the hashes of its turns with their places. Running values are taken within stretches
    of STRETCH turns, and the totals of earlier stretches are added, so a long conversation is not one window.
    """
    rows = turns.select(
        "conv_id", "place", "chars", F.floor((F.col("place") - 1) / STRETCH).alias("stretch"),
        *(F.xxhash64(F.lit(seed), "place", "t1", "t2").alias(f"x{seed}") for seed in (1, 2)))
    within = Window.partitionBy("conv_id", "stretch").orderBy("place")
    running = rows.select("conv_id", "place", "chars", "stretch", *(F.bit_xor(f"x{s}").over(within).alias(f"x{s}") for s in (1, 2)))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "stretch").agg(*(F.bit_xor(f"x{s}").alias(f"x{s}") for s in (1, 2)))
    totals = totals.select("conv_id", "stretch", *(F.bit_xor(f"x{s}").over(before).alias(f"b{s}") for s in (1, 2)))
    totals = _keyed(totals.where("stretch > 0"), "conv_id", "stretch")
    joined = running.join(totals, (F.col("conv_id") == F.col("k_conv_id")) & (F.col("stretch") == F.col("k_stretch")), "left")
    zero = F.lit(0).cast("long")
    roots = conversations.select("conv_id", *(zero.alias(c) for c in ("depth", "p1", "p2", "chars")))
    return roots.unionByName(joined.select(
        "conv_id", F.col("place").cast("long").alias("depth"),
        *(F.col(f"x{s}").bitwiseXOR(F.coalesce(f"b{s}", zero)).alias(f"p{s}") for s in (1, 2)), "chars"))


def nodes_and_steps(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The nodes of a table of prefixes, and where each conversation passes.

    nodes: node (smallest member), depth, parent, members, chars, weight (turns that members have from the node on, itself
    included). steps: conv_id, depth, node, next (node one deeper, null at the end): a row per prefix.
    """
    lengths = _keyed(rows.groupBy("conv_id").agg(F.max("depth").alias("last")), "conv_id")
    sized = rows.join(lengths, F.col("conv_id") == F.col("k_conv_id")).select(
        "conv_id", "depth", "p1", "p2", "chars", (F.col("last") - F.col("depth") + 1).alias("ahead"))
    found = scratch.stage(sized.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("members"), F.any_value("chars").alias("chars"),
        F.sum("ahead").alias("weight")), "found")
    names = _keyed(found.select("depth", "p1", "p2", "node"), "depth", "p1", "p2")
    named = scratch.stage(rows.join(
        names, (F.col("depth") == F.col("k_depth")) & (F.col("p1") == F.col("k_p1")) & (F.col("p2") == F.col("k_p2")))
        .select("conv_id", "depth", "node"), "named")
    after = named.select(F.col("conv_id").alias("of"), (F.col("depth") - 1).alias("at"), F.col("node").alias("next"))
    steps = scratch.stage(named.join(after, (F.col("conv_id") == F.col("of")) & (F.col("depth") == F.col("at")), "left")
                          .select("conv_id", "depth", "node", "next"), "steps")
    # The turn before a node is on the path of the node's own smallest member.
    up = steps.where("next = conv_id").select(
        F.col("conv_id").alias("of"), (F.col("depth") + 1).alias("at"), F.col("node").alias("parent"))
    nodes = found.join(up, (F.col("node") == F.col("of")) & (F.col("depth") == F.col("at")), "left")
    return scratch.stage(nodes.select("node", "depth", "parent", "members", "chars", "weight"), "nodes"), steps


def subtree_sums(nodes: DataFrame, steps: DataFrame, scratch: Scratch, small: int = SMALL) -> DataFrame:
    """(node, depth, a, b): the sums of a and b over the subtree of each node, by centroid decomposition.

    nodes: node, depth, parent (null at a root), weight (sum over the subtree of positive weights) and the numbers a and b (long);
    steps: as nodes_and_steps gives them. ``small`` is the weight up to which a component is finished in a task.
    """
    zero = F.lit(0).cast("long")
    root = F.col("parent").isNull()
    # All nodes of one tree begin in the component of the root; the root is the node of depth 0 on the way.
    tops = steps.where("depth = 0").select(F.col("conv_id").alias("of"), F.col("node").alias("root"))
    state = nodes.join(tops, F.col("node") == F.col("of")).select(
        "node", "depth", "parent", F.coalesce("root", "node").alias("top"), zero.alias("top_depth"),
        "weight", "a", "b", zero.alias("more_a"), zero.alias("more_b"))
    state = scratch.stage(state, "state")
    total = nodes.where(root).agg(F.coalesce(F.sum("weight"), zero)).first()[0]
    limit = max(small, total // LARGE_COMPONENTS)
    done = None
    while True:
        large = state.groupBy("top", "top_depth").agg(F.max("weight").alias("whole")).where(F.col("whole") > limit)
        large = scratch.stage(large, "large")
        if large.isEmpty():
            break
        finished, state = _split(state, _named(large), steps, scratch)
        done = finished if done is None else done.unionByName(finished)
    rest = _finished_in_tasks(state, total, limit)
    return rest if done is None else rest.unionByName(done)


def _named(large: DataFrame) -> DataFrame:
    return large.select(F.col("top").alias("l_top"), F.col("top_depth").alias("l_depth"), *(
        c for c in large.columns if c not in ("top", "top_depth")))


def _split(state: DataFrame, large: DataFrame, steps: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """One split of all large components: the sums of their centroids, and the components that are left."""
    same = (F.col("top") == F.col("l_top")) & (F.col("top_depth") == F.col("l_depth"))
    # The centroid is the lightest node with half of the weight below it. Disjoint large components are at most LARGE_COMPONENTS.
    centres = state.join(F.broadcast(large), same).where("2 * weight >= whole").groupBy("top", "top_depth").agg(
        F.min(F.struct("weight", "node", "depth")).alias("c"))
    centres = scratch.stage(centres.select("top", "top_depth", F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"),
                                           F.col("c.weight").alias("c_weight")), "centres")
    held = state.join(F.broadcast(_named(centres)), same, "left")
    # Where the node's own path passes at the depth of the centroid: below it if that is the centroid.
    passes = steps.select(F.col("conv_id").alias("of"), F.col("depth").alias("at"), F.col("node").alias("passed"), "next")
    placed = held.join(passes, (F.col("node") == F.col("of")) & (F.col("c_depth") == F.col("at")), "left")
    below = (F.col("depth") >= F.col("c_depth")) & (F.col("passed") == F.col("c_node"))
    placed = scratch.stage(placed.withColumn("below", F.coalesce(below, F.lit(False)))
                           .drop("l_top", "l_depth", "of", "at", "passed"), "placed")
    sums = placed.where("below").groupBy("top", "top_depth").agg(
        F.sum("a").alias("sum_a"), F.sum("b").alias("sum_b"), F.any_value("c_node").alias("c_node"),
        F.any_value("c_depth").alias("c_depth"), F.any_value("c_weight").alias("w"))
    sums = scratch.stage(sums, "sums")
    way = steps.join(F.broadcast(sums), F.col("conv_id") == F.col("c_node")).where("depth >= top_depth AND depth < c_depth").select(
        F.col("node").alias("u"), F.col("depth").alias("u_depth"), "sum_a", "sum_b", "w")
    moved = placed.join(way, (F.col("node") == F.col("u")) & (F.col("depth") == F.col("u_depth")), "left")
    zero = F.lit(0)
    own = (F.col("node") == F.col("c_node")) & (F.col("depth") == F.col("c_depth"))
    under = F.col("below") & ~F.coalesce(own, F.lit(False))
    left = moved.where(~F.coalesce(own, F.lit(False))).select(
        "node", "depth", "parent",
        F.when(under, F.col("next")).otherwise(F.col("top")).alias("top"),
        F.when(under, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        (F.col("weight") - F.coalesce("w", zero)).alias("weight"), "a", "b",
        *((F.col(f"more_{x}") + F.coalesce(f"sum_{x}", zero)).alias(f"more_{x}") for x in "ab"))
    of = sums.select(F.col("top").alias("l_top"), F.col("top_depth").alias("l_depth"), "sum_a", "sum_b")
    finished = placed.where(own).join(F.broadcast(of), same).select(
        "node", "depth", *((F.col(f"more_{x}") + F.col(f"sum_{x}")).alias(x) for x in "ab"))
    return scratch.stage(finished, "finished"), scratch.stage(left, "state")


def _finished_in_tasks(state: DataFrame, total: int, limit: int) -> DataFrame:
    """The sums of whole components, dealt to bins of about the weight of a large one."""
    bins = int(total // (2 * limit)) + 1
    names = ["node", "depth", "parent", "top", "top_depth", "weight", "a", "b", "more_a", "more_b"]

    def finish(table: pa.Table) -> pa.Table:
        columns = {n: table[n].to_numpy() if n != "parent" else table[n].fill_null(0).to_numpy() for n in names}
        a, b = decompose(**columns)
        return pa.table({"node": table["node"], "depth": table["depth"], "a": a, "b": b})

    dealt = state.withColumn("bin", F.pmod(F.xxhash64("top", "top_depth"), F.lit(bins)))
    return dealt.groupBy("bin").applyInArrow(finish, "node bigint, depth bigint, a bigint, b bigint")


def decompose(node, depth, parent, top, top_depth, weight, a, b, more_a, more_b) -> tuple[np.ndarray, np.ndarray]:
    """Centroid decomposition of whole components held in arrays: the sums of a and b below each node, and more_a and more_b."""
    n = len(node)
    up, comp = _indices(node, depth, parent, top, top_depth)
    begin, end = _ranges(depth, up, comp, weight)
    weight, sums = weight.astype(np.int64).copy(), [more_a.astype(np.int64).copy(), more_b.astype(np.int64).copy()]
    values, comp, at = [a, b], comp.copy(), np.arange(n)
    centre = np.zeros(n, np.int64)
    while len(at):
        half = at[2 * weight[at] >= weight[comp[at]]]
        half = half[np.lexsort((weight[half], comp[half]))]
        own = half[np.concatenate([[True], comp[half][1:] != comp[half][:-1]])]
        centre[comp[own]] = own
        c = centre[comp[at]]
        below = (begin[at] >= begin[c]) & (begin[at] < end[c])
        inside, of = at[below], c[below]
        added = []
        for value in values:
            found = np.zeros(n, np.int64)
            np.add.at(found, of, value[inside])
            added.append(found[own])
        for total, more in zip(sums, added, strict=True):
            total[own] += more
        # From each centroid to the top of its component.
        here, tops, lost, adds = own, comp[own], weight[own], added
        while True:
            on = here != tops
            if not on.any():
                break
            here, tops, lost, adds = up[here[on]], tops[on], lost[on], [x[on] for x in adds]
            weight[here] -= lost
            for total, more in zip(sums, adds, strict=True):
                total[here] += more
        under = inside[inside != of]
        heads = under[up[under] == centre[comp[under]]]
        key = comp * (int(end.max()) + 1) + begin
        heads = heads[np.argsort(key[heads])]
        if len(under):
            comp[under] = heads[np.searchsorted(key[heads], key[under], side="right") - 1]
        at = at[at != c]
    return sums[0], sums[1]


def _indices(node, depth, parent, top, top_depth) -> tuple[np.ndarray, np.ndarray]:
    """Place of each node's parent (its own at a top), and of its component's top."""
    codes = np.unique(np.concatenate([node, parent, top]))
    deepest = int(depth.max()) + 2

    def key(name, level):
        return np.searchsorted(codes, name) * deepest + level + 1

    keys = key(node, depth)
    order = np.argsort(keys)
    find = lambda wanted: order[np.minimum(np.searchsorted(keys[order], wanted), len(order) - 1)]
    comp = find(key(top, top_depth))
    at_top = (node == top) & (depth == top_depth)
    return np.where(at_top, np.arange(len(node)), find(key(parent, depth - 1))), comp


def _ranges(depth, up, comp, weight) -> tuple[np.ndarray, np.ndarray]:
    """A range of numbers for each node that holds those of the nodes below it and no others; as wide as its weight."""
    n = len(depth)
    begin = np.zeros(n, np.int64)
    tops = np.flatnonzero(up == np.arange(n))
    begin[tops] = np.cumsum(weight[tops]) - weight[tops]
    rest = np.flatnonzero(up != np.arange(n))
    rest = rest[np.argsort(up[rest], kind="stable")]
    if len(rest):
        before = np.cumsum(weight[rest]) - weight[rest]
        first = np.concatenate([[True], up[rest][1:] != up[rest][:-1]])
        begin[rest] = before - np.maximum.accumulate(np.where(first, before, 0)) + 1
        rest = rest[np.argsort(depth[rest], kind="stable")]
        cuts = np.flatnonzero(np.diff(depth[rest])) + 1
        for level in np.split(rest, cuts):
            begin[level] += begin[up[level]]
    return begin, begin + weight


def ends_digest(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, depth, digest): SHA-256 of the sorted, comma-joined conv_id of each node's rows.

    Joined in blocks of BLOCK from range partitions; only the blocks of a node go through one task, as a stream.
    """
    order = ["node", "depth", "conv_id"]
    dealt = scratch.stage(ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).select(
        *order, F.spark_partition_id().alias("part"), F.floor(F.monotonically_increasing_id() / BLOCK).alias("block")), "ends")
    blocks = dealt.groupBy("node", "depth", "part", "block").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select("node", "depth", "part", "block", F.array_join("ids", ",").alias("ids"))
    order = ["node", "depth", "part", "block"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row():
            return pa.RecordBatch.from_pydict({"node": [key[0]], "depth": [key[1]], "digest": [state.hexdigest()]})

        for batch in batches:
            found = []
            for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids")), strict=True):
                if key == (node, depth):
                    state.update(b",")
                else:
                    if key is not None:
                        found.append((*key, state.hexdigest()))
                    key, state = (node, depth), hashlib.sha256()
                state.update(ids.encode())
            if found:
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_pydict(dict(zip(("node", "depth", "digest"), map(list, columns), strict=True)))
        if key is not None:
            yield row()

    dealt = blocks.repartition("node", "depth").sortWithinPartitions(*order).select("node", "depth", "ids")
    return dealt.mapInArrow(digest, "node bigint, depth bigint, digest string")


def conversation_trie(turns: DataFrame, scratch: Scratch, heads: DataFrame | None = None, small: int = SMALL) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, turn, role, text (see ordered_turns for order and nulls); heads: optional, see graft_heads. n_leaves and
    saved_tokens are sums over the subtree: of nodes without children, and of (members - 1) times the characters of the last
    turn. ends_sha256 is of the conversations that end at the node. Repeated rows are turns of their own; an empty table has no node.
    Sequences are told apart by 128 bits of hashes.
    """
    rows = scratch.stage(ordered_turns(turns, scratch), "turns")
    conversations = rows.select("conv_id").distinct()
    if heads is not None:
        rows = graft_heads(rows, heads)
    rows = scratch.stage(prefixes(rows, conversations), "prefixes")
    nodes, steps = nodes_and_steps(rows, scratch)
    children = nodes.where("parent IS NOT NULL").groupBy("parent", "depth").agg(F.count("*").alias("n")).select(
        F.col("parent").alias("of"), (F.col("depth") - 1).alias("at"), "n")
    counted = nodes.join(children, (F.col("node") == F.col("of")) & (F.col("depth") == F.col("at")), "left").select(
        "node", "depth", "parent", "members", "weight", F.coalesce("n", F.lit(0).cast("long")).alias("children"),
        F.when(F.col("n").isNull(), 1).otherwise(0).cast("long").alias("a"),
        ((F.col("members") - 1) * F.col("chars")).alias("b"))
    counted = scratch.stage(counted, "counted")
    sums = subtree_sums(counted.select("node", "depth", "parent", "weight", "a", "b"), steps, scratch, small)
    sums = scratch.stage(sums, "sums_below").select(
        F.col("node").alias("s_node"), F.col("depth").alias("s_depth"), F.col("a").alias("leaves"), F.col("b").alias("saved"))
    ends = scratch.stage(ends_digest(steps.where("next IS NULL"), scratch), "digests").select(
        F.col("node").alias("e_node"), F.col("depth").alias("e_depth"), "digest")
    scratch.drop("counted", "sums_below", "digests")
    joined = counted.join(sums, (F.col("node") == F.col("s_node")) & (F.col("depth") == F.col("s_depth"))).join(
        ends, (F.col("node") == F.col("e_node")) & (F.col("depth") == F.col("e_depth")), "left")
    return joined.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def block_heads(turns: DataFrame, block: int = 100, most: int = 5) -> DataFrame:
    """heads for graft_heads: each conversation takes up to ``most`` first turns of the first one of its block of ids."""
    conversations = turns.where("conv_id IS NOT NULL").select("conv_id").distinct()
    return conversations.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("base"), crc(F.col("conv_id"), most + 1).alias("head"))


def crc(key: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(buckets))
