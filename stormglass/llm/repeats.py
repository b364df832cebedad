"""Exact passages of LENGTH bytes that an earlier document holds, by suffix sorting of what can be repeated.

Every string of ``length`` bytes has one gram that stands for it: the one of its grams with the smallest hash. Strings
of a text with the same gram follow each other and travel as one stretch of text, dealt by the gram, so equal strings always meet.
Whole groups of stretches make shards, whose suffixes are sorted by induction with common prefixes (see induced_sort), which
gives each string the first document that holds it.

Two bitmaps of fixed size keep most of the text from travelling. Units, runs of stretches that end where the text says so, are copies
if an earlier document has the same one; only the first of each takes part in the search. Of those, stretches whose gram occurs
once are left out. What the bitmaps let through wrongly costs work, not results.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormglass.llm.chunks import give_back, slices, text_bytes
from stormglass.llm.induced_sort import Room, suffixes
from stormglass.llm.scratch import Scratch

LENGTH = 50
#: Bits of the filter on grams (16 MB, whatever the size of the corpus).
FILTER_BITS = 27
#: Bytes of different stretches that are sorted at once; a larger group makes a shard of its own, sorted on disk.
SHARD_BYTES = 8_000_000
#: Hashes that a task holds before it hands them on, and that a bucket of the count has on average.
HELD_HASHES, BUCKET_HASHES = 2_000_000, 200_000
#: A unit ends before one stretch in so many, which makes it about 55 bytes longer than a string.
UNIT = 4
_SLICE_BYTES, _BLOCK = 4_000_000, 1 << 16
#: Place of documents without doc_id: behind all others.
_LAST = np.int64(np.iinfo(np.int64).max)
_TABLE = np.random.default_rng(11).integers(1 << 32, size=256, dtype=np.uint32)
_FACTOR = 0x9E3779B1


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of 32 bits of the ``size`` bytes from each place on, as far as they reach."""
    power = lambda n: np.uint32(pow(_FACTOR, n, 1 << 32))
    doubled = {1: _TABLE[data]}
    step = 1
    while 2 * step <= size:
        h = doubled[step]
        doubled[2 * step] = h[:-step] * power(step) + h[step:]
        step *= 2
    found, done = doubled[step], step
    while done < size:
        step = 1 << ((size - done).bit_length() - 1)
        n = len(data) - done - step + 1
        found = found[:n] * power(step) + doubled[step][done:done + n]
        done += step
    found = (found ^ (found >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return found ^ (found >> np.uint32(13))


def _least_places(hashes: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest hash (the first of equal ones) among the ``span`` from each place on."""
    low = (hashes.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    step = 1
    while 2 * step <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < span:
        n = len(hashes) - span + 1
        low = np.minimum(low[:n], low[span - step:span - step + n])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _gram_hashes(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of 64 bits of the ``size`` bytes from each of some places on."""
    found = np.full(len(at), 0x51_7C_C1_B7_27_22_0A_95, np.uint64)
    words = np.lib.stride_tricks.sliding_window_view(data, min(8, size))
    for k in [*range(0, size - 7, 8), *([max(0, size - 8)] if size % 8 else [])]:
        word = np.ascontiguousarray(words[at + k])
        if size < 8:
            word = np.pad(word, ((0, 0), (0, 8 - size)))
        found = (found ^ word.view("<u8").ravel()) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found * np.uint64(0xD6E8FEB86659FD93)


class Stretches(NamedTuple):
    """Stretches of a block: gram, text (its number), and places of the first and last string's begin, and the unit of each."""

    gram: np.ndarray
    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    unit: np.ndarray

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last stretch of each unit."""
        head = np.flatnonzero(np.diff(self.unit, prepend=-1))
        return head, np.append(head[1:], len(self.unit)) - 1

    def only(self, kept: np.ndarray) -> Stretches:
        return Stretches(*(x[kept] for x in self))


def stretches(data: np.ndarray, starts: np.ndarray, length: int) -> Iterator[Stretches]:
    """The stretches of texts by blocks.

    data: texts one after the other, starts: where each begins, and the end. Every place where a string of ``length`` bytes
    begins and ends inside its text is in exactly one stretch.
    """
    gram = length // 2 + 1
    span = length - gram + 1
    for at in range(0, len(data) - length + 1, _BLOCK):
        block = data[at:at + _BLOCK + length - 1]
        n = len(block) - length + 1
        place = _least_places(_rolling(block, gram), span)[:n]
        whole = np.ones(n, bool)
        low, high = np.searchsorted(starts, [at + 1, at + n + length - 1])
        for end in starts[low:high] - at:
            whole[max(0, end - length + 1):end] = False
        new = whole.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~whole[:-1]
        first = np.flatnonzero(new)
        if not len(first):
            continue
        stop = np.ones(n, bool)
        stop[:-1] = new[1:] | ~whole[1:]
        last = np.flatnonzero(stop & whole)
        hashes = _gram_hashes(block, place[first], gram)
        cut = (hashes >> np.uint64(32)) % np.uint64(UNIT) == 0
        cut[1:] |= first[1:] != last[:-1] + 1
        text = np.searchsorted(starts, first + at, side="right") - 1
        yield Stretches(hashes, text, first + at, last + at, np.cumsum(cut))


def _unit_hashes(data: np.ndarray, found: Stretches, length: int) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    head, tail = found.units()
    digests = b"".join(map(xxhash.xxh3_128_digest, _texts(data, found.first[head], found.last[tail], length)))
    both = np.frombuffer(digests, ">u8").astype(np.int64).reshape(-1, 2)
    return both[:, 1], both[:, 0]


def first_units(docs: DataFrame, length: int, scratch: Scratch, filter_bits: int = FILTER_BITS) -> np.ndarray:
    """The filter: a bit for each different unit and the first document that holds it, as packed bytes.

    A unit of a document whose bit is not set is a copy of one in an earlier document, beyond doubt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                rank = part.column("rank").to_numpy()
                data, starts = text_bytes(part.column("text"))
                for found in stretches(data, starts, length):
                    low, high = _unit_hashes(data, found, length)
                    yield pa.RecordBatch.from_pydict({"h1": low, "h2": high, "rank": rank[found.text[found.units()[0]]]})
            give_back()

    units = docs.select("rank", "text").mapInArrow(run, "h1 bigint, h2 bigint, rank bigint")
    firsts = units.groupBy("h1", "h2").agg(F.min("rank").alias("rank"))
    # As in _first_of_unit. Dealt by part of the bitmap, so that each part is made once.
    bit = F.shiftrightunsigned(F.col("h1").bitwiseXOR(F.shiftleft(F.col("rank"), 40)), 64 - filter_bits)
    # Bits of these functions are numbered from 1.
    bits = firsts.select(F.bitmap_bucket_number(bit + 1).alias("part"), F.bitmap_bit_position(bit + 1).alias("at"))
    parts = bits.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("at").alias("marks"))
    marks = np.zeros(1 << (filter_bits - 3), np.uint8)
    for row in scratch.stage(parts, "units").collect():
        at = (row["part"] - 1) * 4096
        marks[at:at + 4096] = np.frombuffer(row["marks"], np.uint8)
    return marks


def _first_of_unit(data: np.ndarray, found: Stretches, rank: np.ndarray, marks: np.ndarray, length: int) -> np.ndarray:
    """Whether the units of stretches may be the first ones."""
    low, _ = _unit_hashes(data, found, length)
    mixed = low.view(np.uint64) ^ (rank[found.text[found.units()[0]]].view(np.uint64) << np.uint64(40))
    bit = (mixed >> np.uint64(64 - (len(marks).bit_length() + 2))).astype(np.int64)
    return ((marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)


def repeated_grams(docs: DataFrame, firsts, length: int, total: int, filter_bits: int = FILTER_BITS) -> np.ndarray:
    """The filter: a bit for each gram that occurs twice or more in first units, as packed bytes.

    Grams are counted exactly by 32 bits and the number of their bucket, of which there are the more the larger the corpus is.
    """
    bits = int(np.clip(np.ceil(np.log2(max(1, total // (13 * BUCKET_HASHES)))), 6, min(20, filter_bits - 3)))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            found = np.repeat(found, np.minimum(n, 2))
            bucket = (found >> np.uint64(64 - bits)).astype(np.int64)
            which, at = np.unique(bucket, return_index=True)
            parts = np.split(((found >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32), at[1:])
            packed = [_packed(x) for x in parts]
            return pa.RecordBatch.from_pydict({"bucket": pa.array(which, pa.int32()), "grams": pa.array(packed, pa.binary())})

        count = 0
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                rank = part.column("rank").to_numpy()
                data, starts = text_bytes(part.column("text"))
                for found in stretches(data, starts, length):
                    first = _first_of_unit(data, found, rank, firsts.value, length)
                    gram = found.gram[np.repeat(first, np.diff(np.append(found.units()[0], len(found.gram))))]
                    if len(gram):
                        held.append(gram)
                        count += len(gram)
                    if count >= HELD_HASHES:
                        yield rows()
                        count = 0
            give_back()
        if held:
            yield rows()

    width = filter_bits - bits

    def fill(table: pa.Table) -> pa.Table:
        found = np.sort(np.concatenate([_unpacked(x) for x in table["grams"].to_pylist()]))
        twice = found[1:][found[1:] == found[:-1]]
        marked = np.zeros(1 << width, bool)
        marked[twice >> np.uint32(32 - width)] = True
        return pa.table({"bucket": table["bucket"][:1], "marks": pa.array([np.packbits(marked).tobytes()], pa.binary())})

    counted = docs.select("rank", "text").mapInArrow(collect, "bucket int, grams binary").groupBy("bucket").applyInArrow(
        fill, "bucket int, marks binary")
    marks = np.zeros((1 << bits, 1 << (width - 3)), np.uint8)
    for row in counted.collect():
        marks[row["bucket"]] = np.frombuffer(row["marks"], np.uint8)
    return marks.ravel()


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte of all: the upper ones are mostly zero and pack well."""
    steps = np.diff(values, prepend=np.uint32(0)).astype(np.uint32)
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


def _candidates(part: pa.RecordBatch, firsts: np.ndarray, marks: np.ndarray, length: int) -> Iterator[tuple]:
    """(data, starts, stretches to be searched, text, begin and end of copied units) by blocks."""
    data, starts = text_bytes(part.column("text"))
    rank = part.column("rank").to_numpy()
    shift = np.uint64(64 - (len(marks).bit_length() + 2))
    for found in stretches(data, starts, length):
        first = _first_of_unit(data, found, rank, firsts, length)
        head, tail = found.units()
        copied = found.text[head[~first]], found.first[head[~first]], found.last[tail[~first]] + length
        found = found.only(np.repeat(first, tail - head + 1))
        bit = (found.gram >> shift).astype(np.int64)
        yield data, starts, found.only(((marks[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).astype(bool)), *copied


def _texts(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> list[bytes]:
    if not len(first):
        return []
    # Only what the strings reach over is copied: they are in order, and those of a block.
    at = int(first[0])
    whole = data[at:int(last[-1]) + length].tobytes()
    return [whole[a:b] for a, b in zip((first - at).tolist(), (last + (length - at)).tolist(), strict=True)]


def _text_hashes(texts: list[bytes]) -> np.ndarray:
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, texts)), ">u8").astype(np.int64)


def first_holders(rows: DataFrame, length: int, shard_bytes: int = SHARD_BYTES, room: Room | None = None) -> DataFrame:
    """(gram, hash, low, high, holder): of each different stretch, runs of strings (numbers low to high) and the first document, by rank,
    that holds them. Strings that only one document holds are left out.

    rows: gram, hash, rank and text of stretches, as occurrences gives them.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, crowded = 0, shard_bytes
        for batch in batches:
            # Whole groups only: what has the last gram of the batch waits for the next one.
            grams = batch.column("gram").to_numpy()
            cut = int(np.searchsorted(grams, grams[-1])) if len(grams) else 0
            if size >= shard_bytes and held and (cut or held[-1].column("gram")[-1].as_py() != grams[0]):
                held.append(batch.slice(0, cut))
                yield from _shard(_different(held), length, room or Room())
                give_back()
                held, size, crowded = [], 0, shard_bytes
                batch = batch.slice(cut)
            if batch.num_rows:
                held.append(batch)
                size += int(pc.sum(pc.binary_length(batch.column("text"))).as_py())
                if size >= crowded:
                    # Copies go before there are too many to hold.
                    held = [_different(held)]
                    size = int(pc.sum(pc.binary_length(held[0].column("text"))).as_py())
                    crowded = max(shard_bytes, 2 * size)
        if held:
            yield from _shard(_different(held), length, room or Room())
        give_back()

    ranked = rows.select("gram", "hash", F.col("rank").alias("low"), F.col("rank").alias("high"), "text")
    dealt = ranked.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(search, "gram bigint, hash bigint, low int, high int, holder bigint")


def _different(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row of each different stretch, in the order of the grams, with its least and greatest rank."""
    table = pa.Table.from_batches(batches)
    gram, hashes = table["gram"].to_numpy(), table["hash"].to_numpy()
    order = np.lexsort((hashes, gram))
    gram, hashes = gram[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return pa.RecordBatch.from_pydict({c: table[c].combine_chunks() for c in table.column_names})
    low, high = (f.reduceat(table[c].to_numpy()[order], first) for f, c in ((np.minimum, "low"), (np.maximum, "high")))
    text = pc.take(table["text"], pa.array(order[first])).combine_chunks()
    return pa.RecordBatch.from_pydict({"gram": gram[first], "hash": hashes[first], "low": low, "high": high, "text": text})


def _shard(table: pa.RecordBatch, length: int, room: Room) -> Iterator[pa.RecordBatch]:
    """The rows of first_holders for whole groups of different stretches, in the order of their grams."""
    if not table.num_rows:
        return
    gram, low, high = (table.column(c).to_numpy() for c in ("gram", "low", "high"))
    group = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    # A group inside one document has nothing to find.
    found = np.minimum.reduceat(low, group) < np.maximum.reduceat(high, group)
    table = table.filter(pa.array(np.repeat(found, np.diff(np.append(group, len(gram))))))
    if not table.num_rows:
        return
    gram, hashes, low, high = (table.column(c).to_numpy() for c in ("gram", "hash", "low", "high"))
    data, starts = text_bytes(table.column("text").cast(pa.large_binary()).view(pa.large_string()))
    sizes = np.diff(starts)
    # Bytes of UTF-8 are below 254: 1 ends a stretch and 0 the text.
    n = len(data) + len(sizes) + 1
    text = room.full(n + 8, np.uint8, 0)
    begins = starts[:-1] + np.arange(len(sizes))
    for part in room.parts(len(sizes)):
        here = data[starts[part.start]:starts[part.stop]] + np.uint8(2)
        text[begins[part.start]:starts[part.stop] + part.stop] = np.insert(here, starts[part.start + 1:part.stop + 1] - starts[part.start], 1)
    run_of = room.full(n, np.int32 if n < 1 << 31 else np.int64, -1)
    run, runs = -1, 0
    for places, common in suffixes(text, n, length, room):
        numbers = run + np.cumsum(common < length)
        run = int(numbers[-1])
        run_of[places] = numbers
        runs = run + 1
    first, last = room.full(runs, np.int64, _LAST), room.full(runs, np.int64, np.iinfo(np.int64).min)
    for part in room.parts(len(sizes)):
        of, at, _ = _strings(begins, sizes, part, length)
        np.minimum.at(first, run_of[at], low[of])
        np.maximum.at(last, run_of[at], high[of])
    for part in room.parts(len(sizes)):
        of, at, number = _strings(begins, sizes, part, length)
        holder = first[run_of[at]]
        useful = last[run_of[at]] > holder
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | (holder[1:] != holder[:-1]) | (useful[1:] != useful[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1
        kept = useful[head]
        head, tail = head[kept], tail[kept]
        if len(head):
            yield pa.RecordBatch.from_pydict({
                "gram": gram[of[head]], "hash": hashes[of[head]], "low": number[head].astype(np.int32),
                "high": number[tail].astype(np.int32), "holder": holder[head]})


def _strings(begins, sizes, part: slice, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretch, place and number in it of all strings of a part of the stretches."""
    count = sizes[part] - length + 1
    of = np.repeat(np.arange(part.start, part.stop), count)
    number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    return of, begins[of] + number, number


def occurrences(docs: DataFrame, firsts, marks, length: int) -> DataFrame:
    """(rank, key, low, high, gram, hash, text): copied units as ranges of bytes (gram is null), and the stretches to be searched, with their
    text (low: where the first string begins, high is null).

    docs: rank (long), key and text; firsts, marks: broadcast filters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                rank, key = part.column("rank").to_numpy(), part.column("key").to_numpy()
                for data, starts, found, text, low, high in _candidates(part, firsts.value, marks.value, length):
                    # Neighbours overlap and become one range.
                    new = np.ones(len(text), bool)
                    new[1:] = (text[1:] != text[:-1]) | (low[1:] > high[:-1])
                    head = np.flatnonzero(new)
                    of, begin, end = text[head], low[head], high[np.append(head[1:], len(text))[:len(head)] - 1]
                    yield pa.RecordBatch.from_pydict({
                        "rank": rank[of], "key": key[of], "low": begin - starts[of], "high": end - starts[of],
                        "gram": pa.nulls(len(of), pa.int64()), "hash": pa.nulls(len(of), pa.int64()),
                        "text": pa.nulls(len(of), pa.binary())})
                    body = _texts(data, found.first, found.last, length)
                    yield pa.RecordBatch.from_pydict({
                        "rank": rank[found.text], "key": key[found.text], "low": found.first - starts[found.text],
                        "high": pa.nulls(len(found.text), pa.int64()), "gram": found.gram.view(np.int64),
                        "hash": _text_hashes(body), "text": pa.array(body, pa.binary())})
            give_back()

    return docs.select("rank", "key", "text").mapInArrow(
        run, "rank bigint, key bigint, low bigint, high bigint, gram bigint, hash bigint, text binary")


def covered(docs: DataFrame, scratch: Scratch, length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
            room: Room | None = None) -> DataFrame:
    """(rank, key, spans): for each document with repeated bytes, the ranges of bytes that strings of earlier documents cover.

    docs: rank (long, the order of the documents), key (long) and text. Ranges may overlap. Documents of equal rank are neither
    earlier nor later than each other; those that repeat rank and key are one.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    context = scratch.spark.sparkContext
    firsts = context.broadcast(first_units(docs, length, scratch))
    marks = context.broadcast(repeated_grams(docs, firsts, length, total))
    rows = scratch.stage(occurrences(docs, firsts, marks, length), "occurrences")
    searched = rows.where("gram IS NOT NULL")
    holders = scratch.stage(first_holders(searched, length, shard_bytes, room), "holders").select(
        F.col("gram").alias("h_gram"), F.col("hash").alias("h_hash"), F.col("low").alias("from"), F.col("high").alias("to"), "holder")
    found = searched.drop("text").join(
        holders, (F.col("gram") == F.col("h_gram")) & (F.col("hash") == F.col("h_hash")) & (F.col("rank") > F.col("holder")))
    spans = rows.where("gram IS NULL").select("rank", "key", "low", "high").unionByName(found.select(
        "rank", "key", (F.col("low") + F.col("from")).alias("low"), (F.col("low") + F.col("to") + length).alias("high")))
    return spans.groupBy("rank", "key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def remove_repeats(docs: DataFrame, scratch: Scratch, length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
                   room: Room | None = None) -> DataFrame:
    """The documents without bytes that are repeated, as kept (binary), with n_bytes, n_removed and n_spans.

    A byte goes if a string of ``length`` bytes around it, inside its text as UTF-8, also begins in a document with a smaller doc_id; what
    is repeated is judged on the input. docs: doc_id and text; other columns stay, unless the result has such a name (names that begin
    with r_ are reserved). A null doc_id is behind all others; documents of equal doc_id take nothing from each other; a null text is
    empty; repeated rows all get the same result. Bytes are removed as such, so what stays need not be UTF-8.
    """
    kept = [c for c in docs.columns if c not in ("kept", "n_bytes", "n_removed", "n_spans")]
    ranked = docs.select(*kept, F.coalesce("doc_id", F.lit(int(_LAST))).cast("long").alias("r_rank"),
                         F.xxhash64("text").alias("r_key"))
    spans = covered(ranked.select(F.col("r_rank").alias("rank"), F.col("r_key").alias("key"), "text"),
                    scratch, length, shard_bytes, room)
    spans = scratch.stage(spans, "spans").select(
        F.col("rank").alias("r_of"), F.col("key").alias("r_text"), F.col("spans").alias("r_spans"))
    scratch.drop("spans")
    joined = ranked.join(spans, (F.col("r_rank") == F.col("r_of")) & (F.col("r_key") == F.col("r_text")), "left")
    schema = docs.select(*kept, F.lit(None).cast("binary").alias("kept"), *(
        F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans"))).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                texts = pc.fill_null(part.column("text").cast(pa.large_string()), "").cast(pa.large_binary())
                rows = [_without(text.as_buffer(), spans) for text, spans in zip(texts, part.column("r_spans"), strict=True)]
                bodies, sizes, removed, runs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(bodies, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs))],
                    schema=None, names=[*kept, "kept", "n_bytes", "n_removed", "n_spans"])
            give_back()

    return joined.select(*kept, "r_spans").mapInArrow(cut, schema)


def _without(text: pa.Buffer, spans: pa.ListScalar) -> tuple[bytes, int, int, int]:
    """A text without spans, its size, the bytes removed and the number of runs removed."""
    if not spans.is_valid or not len(spans.values):
        return text.to_pybytes(), text.size, 0, 0
    low, high = (spans.values.field(c).to_numpy() for c in ("low", "high"))
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate([[True], low[1:] > high[:-1]])
    first = np.flatnonzero(new)
    low, high = low[first], high[np.append(first[1:], len(high)) - 1]
    view = memoryview(text)
    body = b"".join([view[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), text.size], strict=True)])
    return body, text.size, text.size - len(body), len(first)


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and the SHA-256 of the bytes that stay."""
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
