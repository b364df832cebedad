"""Near-duplicate documents by improved consistent weighted sampling of TF-IDF shingles.

A document is a weighted set of five-word shingles. Each sample of it is a shingle with a level of its
weight, and two documents share a sample as often as their weighted Jaccard similarity says. Bands of samples
give candidates; what is reported was verified on the whole sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormglass.llm.chunks import give_back, slices, split_words
from stormglass.llm.components import connected
from stormglass.llm.scratch import Scratch

WORDS, LEAST = 5, 0.8
#: At similarity 0.8 a pair shares one of 10 bands of 3 samples in 99.9 % of all cases.
BANDS, BAND_SAMPLES = 10, 3
#: Pairs that share fewer of their samples are not verified; at similarity 0.8 that is 1 in 500.
SHARED_SAMPLES = 17
#: Texts of a bucket that are compared each with each, where they are not linked yet.
SMALL_BUCKET = 32
#: Texts of a larger bucket that the others are compared with, in each round after the first.
CENTRES = 3
#: Rounds with centres give way to the search by rare shingles when one finds less than this share of all links.
FEW_LINKS = 0.01
#: Document frequencies are counted in so many cells, shingles sharing one by hash, in parts of PART cells.
CELLS, PART = 1 << 20, 1 << 10
_SLICE_BYTES, _BLOCK_SHINGLES = 6_000_000, 100_000
_DRAWS = 1 << 16
#: Sums of weights that stand for a text in the search by rare shingles.
SKETCH = 128
#: Allowed to sums of weights before a pair is left out; the similarity itself is computed anew.
_ROUNDING = 1e-6
#: The same for sketches, whose sums have 24 bits.
_SKETCH_ROUNDING = 1e-5


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits, scattered."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text by hash, how often each occurs in it, and where those of a text begin.

    Words are what ASCII white space parts, in lower case. A text of fewer words is one shingle; one without
    words has none.
    """
    import xxhash

    distinct, codes, rows = split_words(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    word = np.append(hashes[codes], np.zeros(words, np.uint64))
    lengths = np.diff(rows)
    count = np.where(lengths > 0, np.maximum(lengths - words + 1, 1), 0)
    text = np.repeat(np.arange(len(lengths)), count)
    start = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + rows[:-1][text]
    end = rows[1:][text]
    value = np.zeros(len(text), np.uint64)
    for k in range(words):
        value = (value + np.where(start + k < end, word[start + k], np.uint64(k))) * np.uint64(0xA0761D6478BD642F)
        value ^= value >> np.uint64(32)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(value)))
    return value[first], times, np.searchsorted(text[first], np.arange(len(lengths) + 1))


def _cell(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(20)).astype(np.int64) % CELLS


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Weight of the shingles of each cell, from 2 (in no document) down to 1 (in all).

    The weight is 1 + log(documents / documents with a shingle of the cell) / log(documents). All documents are
    counted. The table has CELLS numbers at any size of the corpus; shingles that share a cell share its count, as with
    hashed term frequencies.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                found += np.bincount(_cell(shingles(part.column("text"))[0]), minlength=CELLS)
            give_back()
        packed = [zlib.compress(x.tobytes(), 1) for x in found.reshape(-1, PART)]
        yield pa.RecordBatch.from_pydict({"part": np.arange(len(packed), dtype=np.int32),
                                          "counts": pa.array(packed, pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in table["counts"].to_pylist())
        return pa.table({"part": table["part"][:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    counted = docs.select("text").mapInArrow(count, "part int, counts binary")
    # Added up in two steps, so that no task gets a row from every other.
    counted = counted.withColumn("some", F.floor(F.spark_partition_id() / 64))
    for keys in (["part", "some"], ["part"]):
        counted = counted.groupBy(*keys).applyInArrow(add, "part int, counts binary")
        if keys != ["part"]:
            counted = counted.withColumn("some", F.lit(0))
    frequency = np.zeros((CELLS // PART, PART), np.int64)
    for row in counted.select("part", "counts").collect():
        frequency[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    total = docs.count() + 1
    weight = 1.0 + np.log(total / (frequency.ravel() + 1.0)) / np.log(max(total, 2))
    return np.clip(weight, 1.0, 2.0).astype(np.float32)


@dataclass
class Draws:
    """Random numbers of the sampling, looked up by hash of shingle and sample."""

    scale: np.ndarray  # Gamma(2, 1)
    shift: np.ndarray  # uniform
    bound: np.ndarray  # log of Gamma(2, 1), less the scale
    factors: np.ndarray  # an odd number per sample

    @classmethod
    def make(cls, samples: int, seed: int = 6) -> Draws:
        random = np.random.default_rng(seed)
        scale = random.gamma(2.0, 1.0, _DRAWS)
        bound = np.log(random.gamma(2.0, 1.0, _DRAWS)) - scale
        factors = random.integers(1 << 62, size=samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        return cls(scale.astype(np.float32), random.random(_DRAWS).astype(np.float32), bound.astype(np.float32), factors)


def samples(value: np.ndarray, weight: np.ndarray, begins: np.ndarray, draws: Draws) -> np.ndarray:
    """A row of sample hashes for each set; sets are neither empty nor apart (begins: where each starts, and the end)."""
    out = np.empty((len(begins) - 1, len(draws.factors)), np.uint64)
    log_weight = np.log(weight).astype(np.float32)
    done = 0
    while done < len(begins) - 1:
        upto = max(done + 1, int(np.searchsorted(begins, begins[done] + _BLOCK_SHINGLES, side="right")) - 1)
        here = slice(begins[done], begins[upto])
        first = begins[done:upto] - begins[done]
        size = np.diff(begins[done:upto + 1])
        v, w = value[here], log_weight[here]
        for k, factor in enumerate(draws.factors):
            drawn = v * factor
            at = (drawn >> np.uint64(48)).astype(np.intp)
            scale = draws.scale[at]
            level = np.floor(w / scale + draws.shift[at])
            score = draws.bound[at] - scale * (level - draws.shift[at])
            least = np.repeat(np.minimum.reduceat(score, first), size)
            best = np.flatnonzero(score == least)
            # Equal scores go to the smallest hash, so that equal sets always give equal samples.
            owner = np.searchsorted(first, best, side="right") - 1
            best = best[np.lexsort((drawn[best], owner))]
            owner = np.searchsorted(first, best, side="right") - 1
            best = best[np.searchsorted(owner, np.arange(len(first)))]
            out[done:upto, k] = _mixed(v[best] ^ (level[best].astype(np.int64).astype(np.uint64) * factor))
        done = upto
    return out


def signatures(docs: DataFrame, idf: np.ndarray, bands: int = BANDS, band_samples: int = BAND_SAMPLES) -> DataFrame:
    """Columns of the rows (without text) with samples (array of int) and bands (array of long); null without words."""
    count = bands * band_samples
    shared = docs.sparkSession.sparkContext.broadcast((idf, Draws.make(count).__dict__))
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept, F.lit(None).cast("array<int>").alias("samples"),
                         F.lit(None).cast("array<bigint>").alias("bands")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, fields = shared.value
        draws = Draws(**fields)
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                value, times, begins = shingles(part.column("text"))
                full = np.flatnonzero(np.diff(begins) > 0)
                drawn = samples(value, times * idf[_cell(value)], np.append(begins[full], len(value)), draws)
                keys = np.zeros((len(full), bands), np.uint64)
                for k in range(band_samples):
                    keys = _mixed(keys + drawn[:, k::band_samples])
                keys = _mixed(keys ^ np.arange(bands, dtype=np.uint64))
                lists = []
                for numbers, kind in ((drawn.astype(np.uint32).view(np.int32), pa.int32()), (keys.view(np.int64), pa.int64())):
                    has = np.diff(begins) > 0
                    offsets = np.concatenate([[0], np.cumsum(has * numbers.shape[1])]).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers.ravel(), kind),
                                                          mask=pa.array(~has)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *lists],
                                                 names=[*kept, "samples", "bands"])
            give_back()

    return docs.select(*kept, "text").mapInArrow(run, schema)


def similarities(pairs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(a, b, similarity) of rows with a, b, text_a and text_b: weighted Jaccard of all their shingles."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)

    def weighted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        value, times, begins = shingles(texts)
        return value, times * shared.value[_cell(value)].astype(np.float64), np.repeat(
            np.arange(len(texts)), np.diff(begins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", _SLICE_BYTES // 2):
                (va, wa, ra), (vb, wb, rb) = weighted(part.column("text_a")), weighted(part.column("text_b"))
                value, weight, row = (np.concatenate(x) for x in ((va, vb), (wa, wb), (ra, rb)))
                order = np.lexsort((value, row))
                value, weight, row = value[order], weight[order], row[order]
                same = np.flatnonzero((value[1:] == value[:-1]) & (row[1:] == row[:-1]))
                common = np.bincount(row[same], np.minimum(weight[same], weight[same + 1]), part.num_rows)
                total = np.bincount(row, weight, part.num_rows) - common
                found = np.divide(common, total, out=np.zeros(part.num_rows), where=total > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(found)],
                                                 names=["a", "b", "similarity"])
            give_back()

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint, similarity double")


def row_keys() -> list[Column]:
    """Two hashes that stand for a row's doc_id and text."""
    return [F.xxhash64(F.lit(seed), "doc_id", "text").alias(f"key{seed}") for seed in (1, 2)]


def _text_keys() -> list[Column]:
    return [F.xxhash64(F.lit(seed), "text").alias(f"text{seed}") for seed in (1, 2)]


def near_documents(docs: DataFrame, scratch: Scratch, least: float = LEAST) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its group), kept (one row of each group), key1, key2.

    docs: doc_id and text; other columns are ignored. Documents of equal text, and those whose
    weighted similarity was found to be ``least`` or more, are linked, and linked documents form groups. A null
    text and one without words are like no other document. The kept row is that of the smallest doc_id (null
    last, ties by key); of rows that repeat doc_id and text all bear the mark, and ``keep_one`` leaves one.

    Equal texts are one text until the end. First every band bucket compares its most typical text with the others. Then
    buckets of at most SMALL_BUCKET texts compare all that are not yet in one component, while larger ones go on
    with a few texts after the others, while that finds many links. What large buckets have left in different components is
    then searched by rare shingles (see rare_shingles), which misses no pair of their texts.
    """
    docs = docs.select("doc_id", "text")
    idf = inverse_frequencies(docs)
    signed = scratch.stage(signatures(docs.select("doc_id", "text", *row_keys(), *_text_keys()), idf), "signed")
    texts = scratch.stage(
        signed.where("samples IS NOT NULL").groupBy("text1", "text2")
        .agg(F.any_value("samples").alias("samples"), F.any_value("bands").alias("bands"))
        .withColumn("cls", F.monotonically_increasing_id()), "texts")
    buckets = scratch.stage(_shared_buckets(texts), "buckets")
    members = _verified_links(docs, texts, buckets, idf, least, scratch)
    return _documents(signed, texts, members, scratch)


def _shared_buckets(texts: DataFrame) -> DataFrame:
    """(bucket, cls, large, typical) of all band buckets with more than one text.

    typical: how many texts share the bands of a text. In a group of copies of one original, that is largest for
    the original, with which the others have most in common.
    """
    rows = texts.select("cls", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = shared.select((F.col("bucket") + F.lit(0)).alias("b"), "n")
    members = rows.join(shared, F.col("bucket") == F.col("b")).drop("b")
    typical = members.groupBy("cls").agg(F.sum("n").alias("typical"))
    typical = typical.select((F.col("cls") + F.lit(0)).alias("c"), "typical")
    return members.join(typical, F.col("cls") == F.col("c")).select(
        "bucket", "cls", (F.col("n") > SMALL_BUCKET).alias("large"), "typical")


def _with_centres(placed: DataFrame, turn: int) -> DataFrame:
    """(a, b): the texts of each bucket with some of them, where components differ.

    The first turn takes the most typical text, later ones take others by hash and the most typical of some by hash.
    """
    orders = [F.struct(-F.col("typical"), "cls", "component")]
    if turn:
        hashes = [F.xxhash64(F.lit(CENTRES * turn + k), "cls") for k in range(CENTRES)]
        orders = [F.struct(hashes[0], "cls", "component")]
        orders += [F.struct((F.pmod(h, F.lit(4)) > 0), -F.col("typical"), "cls", "component") for h in hashes[1:]]
    centres = placed.groupBy("bucket").agg(*(F.min(x).alias(f"c{k}") for k, x in enumerate(orders)))
    chosen = F.array(*(F.struct(F.col(f"c{k}.cls").alias("cls"), F.col(f"c{k}.component").alias("component"))
                       for k in range(len(orders))))
    centres = centres.select((F.col("bucket") + F.lit(0)).alias("b"), F.explode(F.array_distinct(chosen)).alias("c"))
    centres = centres.select("b", F.col("c.cls").alias("centre"), F.col("c.component").alias("of"))
    pairs = placed.join(centres, F.col("bucket") == F.col("b")).where("component <> of")
    return pairs.select(F.least("cls", "centre").alias("a"), F.greatest("cls", "centre").alias("b"))


def _with_each(placed: DataFrame) -> DataFrame:
    """(a, b): texts of a small bucket whose components differ."""
    other = placed.select(F.col("bucket").alias("b"), F.col("cls").alias("with"), F.col("component").alias("of"))
    pairs = placed.join(other, F.col("bucket") == F.col("b")).where("cls < with AND component <> of")
    return pairs.select(F.col("cls").alias("a"), F.col("with").alias("b"))


def rare_shingles(bodies: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """(token, rest, total) and the columns but text: the rarest shingles of each text, which similar texts must share.

    Shingles are ordered by weight, rarest first, ties by hash. total: weight of the text; rest: weight from this shingle
    on. What two texts have in common is at most the rest of either from their first common shingle on, and it is at
    least ``least`` times the total of either, so that shingle is among those given here for both.
    """
    shared = bodies.sparkSession.sparkContext.broadcast(idf)
    kept = [c for c in bodies.columns if c != "text"]
    schema = bodies.select(*kept, *(F.lit(None).cast(kind).alias(name) for name, kind in (
        ("token", "bigint"), ("rest", "double"), ("total", "double")))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                value, times, begins = shingles(part.column("text"))
                row = np.repeat(np.arange(part.num_rows), np.diff(begins))
                rarity = shared.value[_cell(value)].astype(np.float64)
                order = np.lexsort((value, -rarity, row))
                value, weight = value[order], (times * rarity)[order]
                total = np.bincount(row, weight, part.num_rows)
                rest = np.cumsum(total)[row] - np.cumsum(weight) + weight
                early = np.flatnonzero(rest >= (least - _ROUNDING) * total[row])
                of = pa.array(row[early])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(of) for c in kept), pa.array(value[early].view(np.int64)),
                     pa.array(rest[early]), pa.array(total[row[early]])], names=[*kept, "token", "rest", "total"])
            give_back()

    return bodies.select(*kept, "text").mapInArrow(run, schema)


def sketches(bodies: DataFrame, idf: np.ndarray) -> DataFrame:
    """(of_cls, sketch) of cls and text: the weights of a text's shingles, added up in SKETCH parts by hash.

    The parts of two texts differ by no more than the weights of their shingles do, which is what they have not in common.
    """
    shared = bodies.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                value, times, begins = shingles(part.column("text"))
                row = np.repeat(np.arange(part.num_rows), np.diff(begins))
                place = row * SKETCH + (value % np.uint64(SKETCH)).astype(np.int64)
                sums = np.bincount(place, times * shared.value[_cell(value)].astype(np.float64), part.num_rows * SKETCH)
                offsets = pa.array(np.arange(part.num_rows + 1) * SKETCH, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("cls"), pa.ListArray.from_arrays(offsets, pa.array(sums.astype(np.float32)))], names=["of_cls", "sketch"])
            give_back()

    return bodies.select("cls", "text").mapInArrow(run, "of_cls bigint, sketch array<float>")


def _may_be_similar(least: float) -> Column:
    """Whether sketch and sketch_of differ by no more than those of similar texts of weight total and total_of can.

    What two texts have not in common is, by their similarity, a share of the weight of both.
    """
    apart = F.aggregate(F.zip_with("sketch", "sketch_of", lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0), lambda n, x: n + x)
    return apart <= F.lit((1 - least) / (1 + least) + _SKETCH_ROUNDING) * (F.col("total") + F.col("total_of"))


def _sharing_rare(tokens: DataFrame, sketched: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """(a, b): texts in different components whose first common shingle leaves both enough weight to be similar, and whose
    sketches do not differ too much for that.

    tokens: rare_shingles of texts with cls and component; sketched: their sketches. Texts of the commonest component of a shingle
    are compared with those of the others, not with each other. Of shingles that the same texts have (told by two
    hashes of 64 bits), the rarest stands for all: as the order is one for all texts, it leaves every pair the most weight.
    """
    texts = {f"x{seed}": F.bit_xor(F.xxhash64(F.lit(seed), "cls")) for seed in (1, 2)}
    sizes = tokens.groupBy("token", "component").agg(
        F.count("*").alias("n"), F.sum("rest").alias("rest"), *(x.alias(name) for name, x in texts.items()))
    mixed = sizes.groupBy("token").agg(
        F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"),
        F.sum("rest").alias("rest"), *(F.bit_xor(name).alias(name) for name in texts)).where("parts > 1")
    mixed = mixed.groupBy("n", *texts).agg(F.max(F.struct("rest", "token", "main")).alias("m"))
    mixed = mixed.select(F.col("m.token").alias("t"), "m.main")
    rows = scratch.stage(
        tokens.join(mixed, F.col("token") == F.col("t")).join(sketched, F.col("cls") == F.col("of_cls"))
        .select("token", "cls", "component", "rest", "total", "sketch", (F.col("component") == F.col("main")).alias("main")), "rare")
    other = rows.where("NOT main").select(
        F.col("token").alias("t"), F.col("cls").alias("with"), F.col("component").alias("of"),
        F.col("rest").alias("rest_of"), F.col("total").alias("total_of"), F.col("sketch").alias("sketch_of"))
    enough = F.least("rest", "rest_of") >= (least / (1 + least) - _ROUNDING) * (F.col("total") + F.col("total_of"))
    pairs = rows.join(other, (F.col("token") == F.col("t")) & (F.col("component") != F.col("of"))
                      & (F.col("main") | (F.col("cls") < F.col("with"))) & enough & _may_be_similar(least))
    return pairs.select(F.least("cls", "with").alias("a"), F.greatest("cls", "with").alias("b")).distinct()


def _unmerged(buckets: DataFrame, components: DataFrame) -> DataFrame:
    """(cls, component) of the texts of large buckets that hold more than one component."""
    placed = buckets.where("large").join(components, F.col("cls") == F.col("vertex"), "left").select(
        "bucket", "cls", F.coalesce("component", "cls").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low <> high").select((F.col("bucket") + F.lit(0)).alias("b"))
    return placed.join(mixed, F.col("bucket") == F.col("b"), "left_semi").select("cls", "component").distinct()


def _verified_links(docs: DataFrame, texts: DataFrame, buckets: DataFrame, idf: np.ndarray, least: float,
                    scratch: Scratch) -> DataFrame:
    """(vertex, component) of texts linked over verified similarities."""
    bodies = scratch.stage(_bodies(docs, texts, buckets), "bodies")
    sides = [bodies.select(F.col("cls").alias(f"of_{x}"), F.col("text").alias(f"text_{x}")) for x in "ab"]

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sides[0], F.col("a") == F.col("of_a")).join(sides[1], F.col("b") == F.col("of_b"))
        return scratch.stage(similarities(both, idf).where(F.col("similarity") >= least).select("a", "b"), "links")

    links = tested = components = None
    turn = known = 0
    while True:
        placed = buckets.withColumn("component", F.col("cls"))
        if turn:
            placed = (
                buckets.where("large" if turn > 1 else "true")
                .join(components, F.col("cls") == F.col("vertex"), "left")
                .select("bucket", "cls", "large", "typical", F.coalesce("component", "cls").alias("component")))
        if turn == 1:
            pairs = _with_centres(placed.where("large"), turn).unionByName(_with_each(placed.where("NOT large")))
        else:
            pairs = _with_centres(placed, turn)
        pairs = pairs.distinct()
        if turn:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.stage(_alike(pairs, texts), "pairs")
        found = verified(pairs)
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        new = found.count()
        known += new
        if new or not turn:
            components = scratch.stage(connected(links, scratch), "members")
        if turn and new <= FEW_LINKS * known:
            break
        turn += 1
    hard = scratch.stage(_unmerged(buckets, components), "hard")
    if hard.isEmpty():
        return components
    wanted = bodies.join(hard.select((F.col("cls") + F.lit(0)).alias("c"), "component"), F.col("cls") == F.col("c")).drop("c")
    sketched = scratch.stage(sketches(wanted, idf), "sketches")
    pairs = _sharing_rare(rare_shingles(wanted, idf, least), sketched, least, scratch)
    pairs = scratch.stage(_alike(pairs.join(tested, ["a", "b"], "left_anti"), texts), "pairs")
    # Each text with the one most like it by samples, then all pairs that this has left in different components.
    best = [pairs.groupBy(x).agg(F.max(F.struct("shared", y)).alias("m")).select(F.col(x), F.col(f"m.{y}").alias(y))
            for x, y in ("ab", "ba")]
    for some in (best[0].unionByName(best[1]).distinct(), None):
        if some is None:
            for x in "ab":
                of = components.select(F.col("vertex").alias(f"v_{x}"), F.col("component").alias(f"of_{x}"))
                pairs = pairs.join(of, F.col(x) == F.col(f"v_{x}"), "left")
            some = pairs.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
        found = verified(some)
        if not found.isEmpty():
            links = links.unionByName(found)
            components = scratch.stage(connected(links, scratch), "members")
    return components


def _alike(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs that share at least SHARED_SAMPLES samples, and how many."""
    sides = [texts.select(F.col("cls").alias(f"of_{x}"), F.col("samples").alias(f"samples_{x}")) for x in "ab"]
    both = pairs.join(sides[0], F.col("a") == F.col("of_a")).join(sides[1], F.col("b") == F.col("of_b"))
    shared = F.aggregate(F.zip_with("samples_a", "samples_b", lambda x, y: (x == y).cast("int")), F.lit(0),
                         lambda n, x: n + x)
    return both.select("a", "b", shared.alias("shared")).where(F.col("shared") >= SHARED_SAMPLES)


def _bodies(docs: DataFrame, texts: DataFrame, buckets: DataFrame) -> DataFrame:
    """(cls, text) of the texts that share a bucket with another."""
    wanted = texts.join(buckets.select("cls").distinct(), "cls", "left_semi").select(
        "cls", F.col("text1").alias("t1"), F.col("text2").alias("t2"))
    found = docs.select("text", *_text_keys()).join(
        wanted, (F.col("text1") == F.col("t1")) & (F.col("text2") == F.col("t2")))
    return found.groupBy("cls").agg(F.any_value("text").alias("text"))


def _documents(signed: DataFrame, texts: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """Groups of texts as groups of documents."""
    grouped = texts.join(members, F.col("cls") == F.col("vertex"), "left").select(
        F.col("text1").alias("t1"), F.col("text2").alias("t2"), F.coalesce("component", "cls").alias("component"))
    grouped = scratch.stage(grouped, "grouped")
    rows = scratch.stage(
        signed.join(grouped, (F.col("text1") == F.col("t1")) & (F.col("text2") == F.col("t2")), "left")
        .select("doc_id", "key1", "key2", "component"), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key1", "key2")).alias("first")
    chosen = scratch.stage(
        rows.where("component IS NOT NULL").groupBy("component").agg(first)
        .select(F.col("component").alias("c"), "first.*").select(
            "c", F.col("doc_id").alias("class_id"), F.col("key1").alias("k1"), F.col("key2").alias("k2")), "chosen")
    scratch.drop("rows", "chosen")
    alone = F.col("component").isNull()
    return rows.join(chosen, F.col("component") == F.col("c"), "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (alone | ((F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2")))).alias("kept"), "key1", "key2")


def keep_one(docs: DataFrame, scratch: Scratch, least: float = LEAST) -> DataFrame:
    """The documents without near duplicates: of each group the kept row, with all its columns.

    Rows without words stay, one of those that repeat doc_id and text.
    """
    kept = scratch.stage(near_documents(docs, scratch, least).where("kept")
                         .select(F.col("key1").alias("m_k1"), F.col("key2").alias("m_k2")).distinct(), "kept")
    scratch.drop("kept")
    keyed = docs.withColumns({"m_key1": row_keys()[0], "m_key2": row_keys()[1]})
    left = keyed.join(kept, (F.col("m_key1") == F.col("m_k1")) & (F.col("m_key2") == F.col("m_k2")), "left_semi")
    return left.dropDuplicates(["m_key1", "m_key2"]).select(*docs.columns)
