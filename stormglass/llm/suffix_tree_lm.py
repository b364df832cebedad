"""Language-model scores by a probabilistic suffix tree over the bytes of the tokens.

A text is its words with one space between them and an end mark; the model gives each byte a probability from the
longest context (up to DEPTH bytes before it) that the tree holds. A context is held if it is frequent
enough and its next bytes differ from those of the context one byte shorter by more than chance and a divergence bound,
or if a longer one is held. A word-frequency score is computed beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormglass.llm.chunks import give_back, slices, split_words, text_bytes
from stormglass.llm.scratch import Scratch

#: Bytes of the longest context. With the byte that follows, they fit a key of 48 bits.
DEPTH = 5
#: Least share of all bytes that a context has, which bounds the contexts of each length by its inverse, and least
#: mean divergence (nats) from the shorter context.
CONTEXT_SHARE, DIVERGENCE = 1e-6, 0.005
#: Words with at least this share of all tokens are looked up in the task; so there are at most half a million.
HEAD_SHARE = 2e-6
_SLICE_BYTES, _HELD_KEYS = 2_000_000, 1_000_000
_END = 10  # the end mark, and what stands before a text: white space is in no word
_END_WORD = np.int64(np.iinfo(np.int64).min)


def lowered(texts: pa.Array) -> pa.Array:
    """A to Z in lower case, other characters as they are; null as empty."""
    data, starts = text_bytes(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    return pa.Array.from_buffers(pa.large_string(), len(starts) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(starts, np.int64)), pa.py_buffer(data)])


def keys_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A key for each byte of each text, end mark included, and where those of each text begin.

    A key is the bytes before it, the nearest first, and then the byte: shorter contexts are its front.
    """
    data, starts = text_bytes(texts)
    inside = (data != 0x20) & ((data < 9) | (data > 13))
    kept = inside.copy()
    kept[:-1] |= ~inside[:-1] & inside[1:]  # the last space before each word
    first = starts[:-1][starts[:-1] < starts[1:]]
    # White space in front of a text's first word goes: nothing of the text stands before it.
    seen = np.concatenate([[0], np.cumsum(inside)])
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    kept &= inside | (seen[:-1] > seen[starts[:-1]][text]) if len(first) else kept
    last = starts[1:][text] - 1
    kept &= inside | (np.arange(len(data)) < last)
    body = np.where(inside, data, np.uint8(0x20))[kept]
    upto = np.concatenate([[0], np.cumsum(kept)])[starts]
    lengths = np.diff(upto)
    row = np.repeat(np.arange(len(lengths)), lengths)
    stream = np.full(len(body) + len(lengths) * (DEPTH + 1), _END, np.uint8)
    stream[np.arange(len(body)) + DEPTH + row * (DEPTH + 1)] = body
    counted = np.ones(len(stream), bool)
    begin = upto[:-1] + np.arange(len(lengths)) * (DEPTH + 1)
    for k in range(DEPTH):
        counted[begin + k] = False
    at = np.flatnonzero(counted)
    key = np.zeros(len(at), np.int64)
    for back in range(1, DEPTH + 1):
        key = (key << 8) | stream[at - back]
    return (key << 8) | stream[at], np.concatenate([[0], np.cumsum(lengths + 1)])


def word_hashes(words: pa.Array) -> np.ndarray:
    import xxhash

    found = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words)).view(np.int64)
    return np.where(found == _END_WORD, 0, found)


def count_symbols(texts: DataFrame) -> DataFrame:
    """(kind, key, n): words by hash (kind 0) and bytes with their contexts (kind 1) of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2

        def rows(kind: int) -> pa.RecordBatch:
            key, n = held[kind]
            held[kind] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
            return pa.RecordBatch.from_pydict({"kind": np.full(len(key), kind, np.int32), "key": key, "n": n})

        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                texts = lowered(part.column("text"))
                words, codes, _ = split_words(texts)
                found = np.append(word_hashes(words), _END_WORD)
                n = np.append(np.bincount(codes, minlength=len(words)), part.num_rows)
                for kind, (key, times) in enumerate(((found, n), np.unique(keys_of(texts)[0], return_counts=True))):
                    held[kind] = _added(*held[kind], key, times)
                    if len(held[kind][0]) > _HELD_KEYS:
                        yield rows(kind)
            give_back()
        yield rows(0)
        yield rows(1)

    counted = texts.select("text").mapInArrow(run, "kind int, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _added(key: np.ndarray, n: np.ndarray, more: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate([key, more]), np.concatenate([n, times])
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


@dataclass
class SuffixTree:
    """Held contexts by length, sorted, the share each leaves to unseen bytes, and probabilities of those seen."""

    root: np.ndarray
    contexts: list[np.ndarray]
    unseen: list[np.ndarray]
    seen: list[np.ndarray]  # context and byte, packed
    probability: list[np.ndarray]

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of the byte of each key, from the longest held context."""
        found = self.root[keys & 255]
        for length in range(1, DEPTH + 1):
            context = keys >> (8 * (DEPTH + 1 - length))
            held, at = _find(self.contexts[length - 1], context)
            known, where = _find(self.seen[length - 1], (context << 8) | (keys & 255))
            value = self.probability[length - 1][where] if len(where) and len(self.seen[length - 1]) else found
            rest = self.unseen[length - 1][at] if len(self.contexts[length - 1]) else 1.0
            found = np.where(known, value, np.where(held, found * rest, found))
        return np.log10(found)


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return sorted_keys[at] == wanted, at


def grow(counts: DataFrame, share: float = CONTEXT_SHARE, divergence: float = DIVERGENCE) -> SuffixTree:
    """The tree of the counts of kind 1. The contexts that are frequent enough to be held, at most 1 / share of each
    length, come to the driver with what follows them."""
    grams = counts.where("kind = 1")
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    levels = grams.select(F.col("key").bitwiseAND(255).alias("byte"), "n", F.posexplode(F.array(*(
        F.shiftright("key", 8 * (DEPTH + 1 - level)) if level else F.lit(0).cast("long")
        for level in range(DEPTH + 1)))).alias("level", "context"))
    rows = (
        levels.groupBy("level", "context", "byte").agg(F.sum("n").alias("n"))
        .groupBy("level", "context").agg(F.sum("n").alias("total"), F.collect_list(F.struct("byte", "n")).alias("next"))
        .where(F.col("total") >= max(1.0, share * total))
        .select("level", "context", "total", F.explode("next").alias("x")).select("level", "context", "total", "x.*"))
    table = rows.toArrow()
    level, context, sums, byte, n = (table[c].to_numpy() for c in ("level", "context", "total", "byte", "n"))
    at_root = level == 0
    times = np.bincount(byte[at_root], n[at_root], 256) if total else np.zeros(256)
    root = (times + 0.5) / (times.sum() + 0.5 * 256)
    parts = [_level(level == k, context, sums, byte, n) for k in range(1, DEPTH + 1)]
    return _pruned(root, parts, divergence)


def _level(here, context, sums, byte, n) -> dict:
    key = (context[here] << 8) | byte[here]
    order = np.argsort(key)
    key, n, sums = key[order], n[here][order].astype(float), sums[here][order].astype(float)
    contexts, first = np.unique(key >> 8, return_index=True)
    return {"key": key, "n": n, "contexts": contexts, "total": sums[first],
            "kinds": np.diff(np.append(first, len(key))).astype(float)}


def _pruned(root: np.ndarray, parts: list[dict], divergence: float) -> SuffixTree:
    """Smooth every context towards the one a byte shorter, test it against that, and keep what passes.

    Smoothing gives each context as many observations of the shorter one's distribution as it has different next bytes.
    """
    above = SuffixTree(root, [], [], [], [])
    for part in parts:
        key, contexts = part["key"], part["contexts"]
        of = np.searchsorted(contexts, key >> 8)
        shorter = _step(above, key)
        total, kinds = part["total"][of], part["kinds"][of]
        gain = np.bincount(of, part["n"] * np.log(part["n"] / total / shorter), len(contexts))
        # More than chance: each next byte costs half the logarithm of the observations.
        part["passes"] = (gain >= part["kinds"] * np.log(part["total"] + 1) / 2) & (gain >= divergence * part["total"])
        above.contexts.append(contexts)
        above.unseen.append(part["kinds"] / (part["total"] + part["kinds"]))
        above.seen.append(key)
        above.probability.append((part["n"] + kinds * shorter) / (total + kinds))
    held = SuffixTree(root, [], [], [], [])
    needed = np.zeros(0, np.int64)
    for k in range(len(parts) - 1, -1, -1):
        contexts = above.contexts[k]
        keep = parts[k]["passes"] | np.isin(contexts, needed)
        needed = contexts[keep] >> 8
        of = keep[np.searchsorted(contexts, above.seen[k] >> 8)] if len(contexts) else np.zeros(0, bool)
        held.contexts.insert(0, contexts[keep])
        held.unseen.insert(0, above.unseen[k][keep])
        held.seen.insert(0, above.seen[k][of])
        held.probability.insert(0, above.probability[k][of])
    return held


def _step(above: SuffixTree, key: np.ndarray) -> np.ndarray:
    """Probability of the byte of each key of the next length, from the contexts built so far."""
    byte, context = key & 255, key >> 16  # without the oldest byte
    found = above.root[byte]
    depth = len(above.contexts)
    for length in range(1, depth + 1):
        front = context >> (8 * (depth - length))
        held, at = _find(above.contexts[length - 1], front)
        known, where = _find(above.seen[length - 1], (front << 8) | byte)
        if len(above.contexts[length - 1]):
            found = np.where(known, above.probability[length - 1][where],
                             np.where(held, found * above.unseen[length - 1][at], found))
    return found


def score_texts(docs: DataFrame, training: Column, scratch: Scratch) -> DataFrame:
    """The rows without text, with n_tokens, n_known, train_tokens, base_score and score.

    docs: text and other columns, kept unless the result has such a name; training: condition on them that marks the texts to learn
    from (null: not). A null text is empty and has the end token alone; repeated rows count as often as they occur. Without
    training texts every token has the base probability 1 and every byte the same one.
    """
    kept = [c for c in docs.columns if c not in ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    counts = scratch.stage(count_symbols(docs.where(training)), "counts")
    words = counts.where("kind = 0")
    tokens, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tree = grow(counts)
    head = words.where(F.col("n") >= max(1.0, HEAD_SHARE * tokens)).select("key", "n").toArrow()
    order = np.argsort(head["key"].to_numpy())
    head_keys, head_counts = (head[c].to_numpy()[order] for c in ("key", "n"))
    shared = scratch.spark.sparkContext.broadcast((tree.__dict__, head_keys, head_counts))
    scored = scratch.stage(
        _scored(docs.select(*kept, "text"), kept, shared).withColumn("m_row", F.monotonically_increasing_id()), "scored")
    rare = words.where(F.col("n") < max(1.0, HEAD_SHARE * tokens)).select("key", F.col("n").alias("times"))
    tail = (
        scored.select("m_row", F.explode("m_tail").alias("word")).join(rare, F.col("word") == F.col("key"), "left")
        .groupBy("m_row").agg(F.sum(F.log10(F.coalesce("times", F.lit(0)) + 0.5)).alias("m_more"),
                              F.count("times").alias("m_known")))
    scratch.drop("counts", "scored")
    norm = float(np.log10(tokens + 0.5 * (kinds + 1)))
    tail = tail.select((F.col("m_row") + F.lit(0)).alias("m_of"), "m_more", "m_known")
    return scored.join(tail, F.col("m_row") == F.col("m_of"), "left").select(
        *kept, "n_tokens", (F.col("m_head") + F.coalesce("m_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("m_logs") + F.coalesce("m_more", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"), "score")


def _scored(docs: DataFrame, kept: list[str], shared) -> DataFrame:
    schema = docs.select(
        *kept, F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("m_head"), F.lit(0.0).alias("m_logs"),
        F.lit(0.0).alias("score"), F.array().cast("array<bigint>").alias("m_tail")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, head_keys, head_counts = shared.value
        tree = SuffixTree(**fields)
        end_known, end_at = _find(head_keys, np.array([_END_WORD]))
        end_count = head_counts[end_at[0]] if end_known[0] else 0
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                texts = lowered(part.column("text"))
                words, codes, rows = split_words(texts)
                found = word_hashes(words)
                known, at = _find(head_keys, found)
                logs = np.where(known, np.log10((head_counts[at] if len(head_counts) else 0) + 0.5), 0.0)
                in_head = known[codes]
                text = np.repeat(np.arange(part.num_rows), np.diff(rows))
                tail = np.bincount(text[~in_head], minlength=part.num_rows)
                keys, begins = keys_of(texts)
                distinct, number = np.unique(keys, return_inverse=True)
                score = np.add.reduceat(tree.log10(distinct)[number], begins[:-1])
                columns = [
                    np.diff(rows) + 1,
                    np.bincount(text, in_head, part.num_rows).astype(np.int64) + int(end_count > 0),
                    np.bincount(text, logs[codes], part.num_rows) + np.log10(end_count + 0.5), score]
                tails = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(tail)]), pa.int32()),
                                                 pa.array(found[codes[~in_head]]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), *map(pa.array, columns), tails],
                    names=[*kept, "n_tokens", "m_head", "m_logs", "score", "m_tail"])
            give_back()

    return docs.mapInArrow(run, schema)
