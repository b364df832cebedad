"""Collocations by vertically partitioned suffix subtrees over words.

A window is the words from one place on, as far as they can belong to a frequent phrase and five at most. Windows are dealt
to groups by a prefix of their words: one word, or as many more as it takes until the prefix occurs no oftener than the budget
of a task allows. Each group builds the subtree of its windows on its own, which are its leaves, and the total of the leaves below a
node is the number of times its phrase occurs; nodes above a long prefix are added up over its groups. Phrases are then scored and
filtered by joins.

A window ends before a word, or a pair or triple of words, that occurs too rarely for any phrase with it; bitmaps of
fixed size tell that, and what they let through wrongly is counted and then left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stormglass.llm.chunks import give_back, slices, text_bytes
from stormglass.llm.scratch import Scratch
from stormglass.llm.suffix_tree_lm import lowered

DEPTH = 5
#: Bits of each of the filters on words, pairs and triples (16 MB).
FILTER_BITS = 27
#: Times that a prefix occurs at most; those that occur oftener are made longer (up to four words). A group has about half of it.
BUDGET = 1_000_000
#: Different words of a result up to which they are looked up in the tasks that have seen the words.
FEW_WORDS = 1 << 20
_HELD_HASHES, _BUCKET_HASHES, _HELD_WINDOWS = 2_000_000, 200_000, 600_000
_SLICE_BYTES = 4_000_000
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x09, 0x20]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_WORDS = [f"w{k}" for k in range(1, DEPTH + 1)]


def words_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words, the number of each word in order, and whether it begins a piece (and so follows no word)."""
    data, starts = text_bytes(lowered(texts))
    kind = _CLASS[data]
    inside = kind == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = starts[:-1][starts[:-1] < starts[1:]]
    begins[first] = inside[first]
    at = np.flatnonzero(begins)
    breaks = np.cumsum(kind == 2, dtype=np.int64)
    piece = (breaks[at] if len(at) else at) + np.searchsorted(starts, at, side="right") * np.int64(1 << 40)
    places = np.cumsum(inside)[at] - 1
    offsets = pa.array(np.append(places, int(inside.sum())), pa.int64())
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, offsets.buffers()[1], pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), np.diff(piece, prepend=-1) != 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def coded_words(part: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(lang, words, ids of the words, number of each word in order, begins of pieces) for each language of a part.

    An id is a hash of 64 bits of the word, seeded by the language; 0 is none.
    """
    import xxhash

    langs = part.column("lang").dictionary_encode()
    for k, lang in enumerate(langs.dictionary.to_pylist()):
        texts = part.column("text").filter(pc.equal(langs.indices, k))
        words, codes, begins = words_of(texts)
        seed = xxhash.xxh3_64_intdigest(lang)
        ids = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
        yield lang, words, np.where(ids == 0, np.uint64(1), ids), codes, begins


def _joined_hashes(front: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Hashes of word sequences, each longer by a word."""
    return _mixed(front * np.uint64(0xD6E8FEB86659FD93) + behind)


def _pairs(ids: np.ndarray, often: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of frequent words that a frequent one follows in the piece, and the hashes of the pairs."""
    at = np.flatnonzero(often[:-1] & often[1:] & ~begins[1:]) if len(ids) else np.zeros(0, np.int64)
    return at, _joined_hashes(ids[at], ids[at + 1])


def _triples(ids: np.ndarray, at: np.ndarray, hashes: np.ndarray, pairs: Often) -> tuple[np.ndarray, ...]:
    """Places and hashes of frequent pairs, whether another follows one word on, and the hashes of those triples.

    at, hashes: as _pairs gives them; pairs: the filter."""
    kept = _holds(pairs, hashes)
    at, hashes = at[kept], hashes[kept]
    longer = np.zeros(len(at), bool)
    longer[:-1] = at[1:] == at[:-1] + 1
    return at, hashes, longer, _joined_hashes(hashes[longer], ids[at[longer] + 2])


class Often(NamedTuple):
    """What is known of hashes that occur often: a bit for each that occurs ``least`` times, as packed bytes; the upper
    32 + bits bits of those that occur more than ``budget`` times, sorted."""

    marks: np.ndarray
    many: np.ndarray
    bits: int


def _many(often: Often, hashes: np.ndarray) -> np.ndarray:
    return np.isin(hashes >> np.uint64(32 - often.bits), often.many)


def _holds(often: Often, hashes: np.ndarray) -> np.ndarray:
    marks = often.marks
    bit = (hashes >> np.uint64(64 - (len(marks).bit_length() + 2))).astype(np.int64)
    return ((marks[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(bool)


def frequent(docs: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], least: int, budget: int, total: int,
             filter_bits: int = FILTER_BITS) -> Often:
    """Which hashes of 64 bits occur ``least`` times or more, by bits that hashes may share, and more than ``budget`` times.

    The latter are at most as many as the budget goes into all hashes. Counts are exact up to 32 bits of a hash and the number of its bucket; what falls together is let through.
    """
    bits = int(np.clip(np.ceil(np.log2(max(1, total // _BUCKET_HASHES))), 6, min(20, filter_bits - 3)))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held) >> np.uint64(32 - bits), return_counts=True)
            held.clear()
            which, at = np.unique(found >> np.uint64(32), return_index=True)
            low = np.split((found & np.uint64(0xFFFFFFFF)).astype(np.uint32), at[1:])
            times = np.split(n.astype(np.uint32), at[1:])
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array(which.astype(np.int32)), "low": pa.array([_planes(x, True) for x in low], pa.binary()),
                "times": pa.array([_planes(x, False) for x in times], pa.binary())})

        count = 0
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                for found in hashes(part):
                    if len(found):
                        held.append(found)
                        count += len(found)
                if count >= _HELD_HASHES:
                    yield rows()
                    count = 0
            give_back()
        if held:
            yield rows()

    width = filter_bits - bits

    def fill(table: pa.Table) -> pa.Table:
        low = np.concatenate([np.cumsum(_plain(x), dtype=np.uint32) for x in table["low"].to_pylist()])
        times = np.concatenate([_plain(x) for x in table["times"].to_pylist()]).astype(np.int64)
        order = np.argsort(low, kind="stable")
        low, times = low[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]])) if len(low) else np.zeros(0, np.int64)
        sums = np.add.reduceat(times, first) if len(first) else times
        low = low[first]
        marked = np.zeros(1 << width, bool)
        marked[low[sums >= least] >> np.uint32(32 - width)] = True
        many = (table["bucket"][0].as_py() << 32) | low[sums > budget].astype(np.int64)
        return pa.table({"bucket": table["bucket"][:1], "marks": pa.array([np.packbits(marked).tobytes()], pa.binary()),
                         "many": pa.array([many.tolist()], pa.list_(pa.int64()))})

    counted = docs.mapInArrow(collect, "bucket int, low binary, times binary").groupBy("bucket").applyInArrow(
        fill, "bucket int, marks binary, many array<bigint>")
    marks, many = np.zeros((1 << bits, 1 << (width - 3)), np.uint8), []
    for row in counted.collect():
        marks[row["bucket"]] = np.frombuffer(row["marks"], np.uint8)
        many += row["many"]
    return Often(marks.ravel(), np.sort(np.array(many, np.int64)).view(np.uint64), bits)


def _planes(values: np.ndarray, sorted_: bool) -> bytes:
    """Numbers of 32 bits (differences of sorted ones) byte by byte of all: the upper ones are mostly zero and pack well."""
    values = np.diff(values, prepend=np.uint32(0)).astype(np.uint32) if sorted_ else values
    return values.view(np.uint8).reshape(-1, 4).T.tobytes()


def _plain(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def dealt_windows(docs: DataFrame, filters, groups: int, depth: int = DEPTH) -> DataFrame:
    """Rows of three kinds: packed windows of a language and group (w1 to w5, 0 behind the last word; front, the words of the prefix; n),
    packed words (w1, word), and the size of a language (size).

    docs: lang and text; filters: broadcast filters on words, pairs and triples. A window or word may be given by several tasks.
    """
    names = [*_WORDS[:depth], "front", "n"]

    def reduced(held: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(held)
        order = np.lexsort([rows[:, k] for k in range(depth - 1, -1, -1)])
        rows = rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :depth] != rows[:-1, :depth]).any(axis=1)
        first = np.flatnonzero(new)
        out = rows[first]
        out[:, -1] = np.add.reduceat(rows[:, -1], first) if len(first) else out[:, -1]
        return out

    def packed(lang: str, held: list[np.ndarray]) -> pa.RecordBatch:
        rows = reduced(held)
        prefix = np.where(np.arange(depth) < rows[:, [depth]], rows[:, :depth], 0).view(np.uint64)
        key = prefix[:, 0]
        for k in range(1, depth):
            key = _joined_hashes(key, prefix[:, k])
        group = (key % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        which, at = np.unique(group[order], return_index=True)
        offsets = pa.array(np.append(at, len(rows)).astype(np.int32))
        lists = {c: pa.ListArray.from_arrays(offsets, pa.array(rows[order, k])) for k, c in enumerate(names)}
        return _rows(len(which), lang, group=which, **lists)

    def spelled(lang: str, known: dict[int, bytes]) -> pa.RecordBatch:
        ids, words = pa.array(list(known), pa.int64()), pa.array(list(known.values()), pa.binary())
        ends = pa.array([0, len(known)], pa.int32())
        return _rows(1, lang, w1=pa.ListArray.from_arrays(ends, ids), word=pa.ListArray.from_arrays(ends, words))

    def _rows(count: int, lang: str, **columns) -> pa.RecordBatch:
        kinds = {"group": pa.int64(), **{c: pa.list_(pa.int64()) for c in names}, "word": pa.list_(pa.binary()), "size": pa.int64()}
        arrays = [pa.array([lang] * count, pa.string()), *(
            pa.array(columns[c], t) if c in columns else pa.nulls(count, t) for c, t in kinds.items())]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        known: dict[str, dict[int, bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                for lang, words, ids, codes, begins in coded_words(part):
                    sizes[lang] = sizes.get(lang, 0) + len(codes)
                    often = _holds(filters[0].value, ids)
                    seen = known.setdefault(lang, {})
                    for k in np.flatnonzero(often):
                        seen.setdefault(int(ids[k].view(np.int64)), words[k])
                    mine = held.setdefault(lang, [])
                    mine.append(_windows(ids[codes], often[codes], begins, [f.value for f in filters], depth))
                    if sum(map(len, mine)) > _HELD_WINDOWS:
                        held[lang] = mine = [reduced(mine)]
                        if len(mine[0]) > _HELD_WINDOWS // 2:
                            yield packed(lang, held.pop(lang))
                    if len(seen) > _HELD_WINDOWS:
                        yield spelled(lang, known.pop(lang))
                if sum(len(x) for mine in held.values() for x in mine) > 2 * _HELD_WINDOWS:
                    yield from (packed(lang, mine) for lang, mine in held.items())
                    held.clear()
            give_back()
        yield from (packed(lang, mine) for lang, mine in held.items())
        yield from (spelled(lang, seen) for lang, seen in known.items())
        yield from (_rows(1, lang, size=[n]) for lang, n in sizes.items())

    schema = "lang string, group bigint, " + ", ".join(f"{c} array<bigint>" for c in names) + ", word array<binary>, size bigint"
    return docs.mapInArrow(run, schema)


def _windows(ids: np.ndarray, often: np.ndarray, begins: np.ndarray, filters: list[Often], depth: int) -> np.ndarray:
    """A row for each frequent word: the words of its window, the length of its prefix, and 1; those of one word only are counted
    together. The prefix has a word more than the longest front of the window that occurs too often for a group."""
    n = len(ids)
    words, pairs, triples = filters
    at, hashes, longer, of_three = _triples(ids, *_pairs(ids, often, begins), pairs)
    third = np.zeros(n + depth, bool)
    known = _holds(triples, of_three)
    third[at[longer][known]] = True
    linked = np.zeros(n, bool)
    linked[at] = True
    alone, n_alone = np.unique(ids[often & ~linked], return_counts=True)
    rows = np.zeros((len(at) + len(alone), depth + 2), np.int64)
    rows[:len(at), 0] = ids[at].view(np.int64)
    rows[len(at):, 0] = alone.view(np.int64)
    rows[:len(at), -1] = 1
    rows[len(at):, -1] = n_alone
    going = np.arange(len(at))
    for k in range(1, depth):
        if k > 1:
            going = going[third[at[going] + k - 2]]
        rows[going, k] = ids[at[going] + k].view(np.int64)
    front = 1 + _many(words, rows[:, 0].view(np.uint64)).astype(np.int64)
    two = np.flatnonzero((front[:len(at)] > 1) & _many(pairs, hashes))
    front[two] = 3
    three = np.zeros(len(at), bool)
    three[np.flatnonzero(longer)[known]] = _many(triples, of_three[known])
    front[two[three[two]]] = 4
    rows[:, depth] = np.minimum(front, depth)
    return rows


def phrase_counts(windows: DataFrame, least: int, scratch: Scratch, depth: int = DEPTH) -> DataFrame:
    """(lang, phrase, f): the phrases (array of ids) of up to ``depth`` words that occur ``least`` times or more.

    windows: packed windows, as dealt_windows gives them.
    """

    def subtree(table: pa.Table) -> pa.Table:
        flat = {c: table[c].combine_chunks().flatten().to_numpy() for c in [*_WORDS[:depth], "front", "n"]}
        order = np.lexsort([flat[w] for w in reversed(_WORDS[:depth])])
        columns = [flat[w][order] for w in _WORDS[:depth]]
        n, front = flat["n"][order], flat["front"][order]
        new = np.zeros(len(n), bool)
        new[:1] = True
        phrases, counts, parts = [], [], []
        for k in range(depth):
            # Nodes of depth k + 1 begin where their words differ from those of the leaf before.
            new[1:] |= columns[k][1:] != columns[k][:-1]
            first = np.flatnonzero(new)
            total = np.add.reduceat(n, first)
            part = front[first] > k + 1
            kept = ((total >= least) | part) & (columns[k][first] != 0)
            first = first[kept]
            phrases += np.stack([c[first] for c in columns[:k + 1]], axis=1).tolist()
            counts.append(total[kept])
            parts.append(part[kept])
        size = len(phrases)
        return pa.table({"lang": pa.array([table["lang"][0].as_py()] * size, pa.string()),
                         "phrase": pa.array(phrases, pa.list_(pa.int64())), "f": np.concatenate(counts), "part": np.concatenate(parts)})

    nodes = scratch.stage(windows.groupBy("lang", "group").applyInArrow(
        subtree, "lang string, phrase array<bigint>, f bigint, part boolean"), "nodes")
    # Nodes above the prefixes of groups; at most as many phrases as occur more often than the budget.
    whole = nodes.where("part").groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return nodes.where("NOT part").drop("part").unionByName(whole)


def scored(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more that no longer one makes needless.

    counts: lang, phrase, f (ids of words are those of a language); sizes: lang, size. The score is that of the worst cut, see collocations.
    """
    size = F.size("phrase")
    candidates = counts.where(size > 1)
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    part = {"l": F.slice("phrase", F.lit(1), F.col("k")), "r": F.slice("phrase", F.col("k") + 1, size - F.col("k"))}
    for name, words in part.items():
        of = counts.select(F.col("phrase").alias(f"{name}_of"), F.col("f").alias(name))
        cuts = cuts.withColumn("words", words).join(of, F.col("words") == F.col(f"{name}_of")).drop("words", f"{name}_of")
    cuts = cuts.join(sizes.select(F.col("lang").alias("of"), "size"), F.col("lang") == F.col("of"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", wide("a") * F.lit(1000).cast("decimal(4,0)") * F.col("size").cast("decimal(15,0)"), wide("l") * wide("r"))
    worst = cuts.groupBy("lang", "phrase", "a", F.col("size").alias("n")).agg(
        F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("worst"))
    # A phrase inside a longer one that occurs as often is inside one that is longer by a word and occurs as often.
    longer = candidates.where(size > 2).select("f", F.explode(F.array(
        F.slice("phrase", F.lit(1), size - 1), F.slice("phrase", F.lit(2), size - 1))).alias("inside"))
    longer = longer.groupBy("inside").agg(F.max("f").alias("most"))
    kept = worst.join(longer, F.col("phrase") == F.col("inside"), "left").where("most IS NULL OR most < a")
    return kept.select("lang", "phrase", "a", "worst.l", "worst.r", "n", "worst.score")


def collocations(docs: DataFrame, scratch: Scratch, least: int = 100, top: int = 2000, budget: int = BUDGET,
                 depth: int = DEPTH) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language by score, count and spelling.

    docs: lang (null: und) and text (null: empty); other columns are ignored. A to Z count as lower case; [.,;:!?] and line ends (0A to 0D)
    part pieces, blanks and tabs words. n counts the words of a language, a the phrase, within pieces and with overlaps. A phrase
    of 2 to ``depth`` words with a >= least is cut behind its first words into parts that occur l and r times, where
    floor(1000 a n / (l r)) is lowest (ties: the shortest first part); that is its score. Phrases whose words stand inside a longer one with
    the same count are left out. Ties are broken by the bytes of the phrase, so the result is one whatever the order of the rows;
    repeated rows count as often as they occur; an empty table gives no rows. Words are told apart by 64 bits of a hash.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    context = scratch.spark.sparkContext
    total = (docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // 6

    def words(part: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, ids, codes, _ in coded_words(part):
            yield ids[codes]

    single = context.broadcast(frequent(docs, words, least, budget, total))

    def pairs(part: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, ids, codes, begins in coded_words(part):
            yield _pairs(ids[codes], _holds(single.value, ids)[codes], begins)[1]

    double = context.broadcast(frequent(docs, pairs, least, budget, total))

    def triples(part: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, ids, codes, begins in coded_words(part):
            yield _triples(ids[codes], *_pairs(ids[codes], _holds(single.value, ids)[codes], begins), double.value)[3]

    triple = context.broadcast(frequent(docs, triples, least, budget, total))
    rows = scratch.stage(dealt_windows(docs, (single, double, triple), 2 * total // budget + 1, depth), "windows")
    counts = scratch.stage(phrase_counts(rows.where("group IS NOT NULL"), least, scratch, depth), "counts")
    sizes = rows.where("size IS NOT NULL").groupBy("lang").agg(F.sum("size").alias("size"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    found = scored(counts, sizes).withColumn("place", F.rank().over(best)).where(F.col("place") <= top)
    found = scratch.stage(found.drop("place"), "best")
    wanted = found.select(F.explode("phrase").alias("id")).distinct()
    spelled = scratch.stage(_spelled(rows.where("word IS NOT NULL").select("w1", "word"), wanted), "words")
    scratch.drop("best", "words")
    named = found.select("lang", "a", "l", "r", "n", "score", "phrase", F.posexplode("phrase").alias("at", "w")).join(
        spelled, F.col("w") == F.col("id"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"].cast("string")), " ")
    named = named.groupBy("lang", "phrase", "a", "l", "r", "n", "score").agg(joined.alias("text"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("text"))
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")


def _spelled(packed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, word) of the wanted ids, from packed words."""
    few = wanted.limit(FEW_WORDS + 1).toArrow()["id"].to_numpy()
    if len(few) <= FEW_WORDS:
        ids = packed.sparkSession.sparkContext.broadcast(np.sort(few))

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held, words = (batch.column(c).flatten() for c in ("w1", "word"))
                kept = pa.array(np.isin(held.to_numpy(), ids.value))
                yield pa.RecordBatch.from_arrays([held.filter(kept), words.filter(kept)], names=["id", "word"])

        rows = packed.mapInArrow(pick, "id bigint, word binary")
    else:
        rows = packed.select(F.explode(F.arrays_zip("w1", "word")).alias("x")).select(F.col("x.w1").alias("id"), "x.word")
        rows = rows.join(wanted.select((F.col("id") + F.lit(0)).alias("k")), F.col("id") == F.col("k"), "left_semi")
    return rows.groupBy("id").agg(F.any_value("word").alias("word"))
