"""SentencePiece (BPE) encoding by suffix-array matching, and decoding.

The chunks of a batch's text (spaces and what follows up to the next space) are laid out once each in one
sequence, which is indexed by a suffix array. Every piece of the vocabulary is looked up by binary search;
the occurrences are the edges of a lattice, sorted by the position where they end, longest first. Relaxing
them from left to right keeps at each position the one piece that ends the merge order's own segmentation
up to there: an edge fits if its piece and the last one before it are what merging leaves side by side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormglass.llm.chunks import give_back, slices, split_chunks

#: Vocabulary file, a parameter of all entry points.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text whose chunks are told apart at a time, and characters of distinct chunks indexed at a time.
SLICE_BYTES, INDEX_CHARS = 4_000_000, 250_000

#: Characters packed into a sort key, bits of each.
_PACK, _BITS = 4, 15
_SPACE = "▁"


@dataclass
class Vocabulary:
    """Arrays of a vocabulary. Pieces are numbered as in the file; one number more stands for unknown characters."""

    pieces: list[bytes]  # what a piece decodes to
    lengths: np.ndarray  # in characters, 0 for pieces that never match text
    keys: np.ndarray  # packed characters of the matched pieces, one row each
    matched: np.ndarray  # their numbers
    alphabet: np.ndarray  # code points, sorted; a character's number is its place + 1
    order: np.ndarray  # when a piece is merged, -1 for single characters
    left: np.ndarray
    right: np.ndarray
    pairs: np.ndarray  # sorted left * size + right of all merges
    pair_order: np.ndarray
    bytes_at: int  # number of the piece for byte 0
    unknown: int


def _merged(text: str, rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """What merging makes of a text, and the last merge."""
    parts, last = list(text), None
    while True:
        ranks = [rank.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        best = min((r, i) for i, r in enumerate(ranks) if r is not None) if any(r is not None for r in ranks) else None
        if best is None:
            return parts, last
        i = best[1]
        last = (parts[i], parts[i + 1])
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Arrays of a SentencePiece BPE model with byte fallback and identity normalisation."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    text = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(size)]
    number = {t: i for i, t in enumerate(text) if not special[i]}
    by_score = sorted((t for t in number if len(t) > 1), key=lambda t: (-model.get_score(number[t]), number[t]))
    rank = {t: k for k, t in enumerate(by_score)}
    order, left, right = (np.full(size + 1, -1, np.int64) for _ in range(3))
    lengths = np.zeros(size + 1, np.int64)
    pairs = {}
    for t, i in number.items():
        if len(t) == 1:
            lengths[i] = 1
            continue
        for cut in range(1, len(t)):
            a, b = number.get(t[:cut]), number.get(t[cut:])
            if a is not None and b is not None:
                pairs[a * (size + 1) + b] = rank[t]
        parts, last = _merged(t, rank)
        order[i] = rank[t]
        if len(parts) == 1:  # else merging never yields this piece
            lengths[i] = len(t)
            left[i], right[i] = number[last[0]], number[last[1]]
    lengths[size] = 1
    alphabet = np.array(sorted({ord(c) for t in number for c in t}), np.uint32)
    matched = np.array([i for i in number.values() if lengths[i]])
    width = -(-int(lengths.max()) // _PACK) * _PACK
    chars = np.zeros((len(matched), width), np.int64)
    for row, i in enumerate(matched):
        points = np.array([ord(c) for c in text[i]], np.uint32)
        chars[row, :len(points)] = np.searchsorted(alphabet, points) + 1
    bytes_at = next(i for i in range(size) if model.is_byte(i))
    decoded = [
        bytes([i - bytes_at]) if model.is_byte(i) else b"" if model.is_control(i)
        else " ⁇ ".encode() if model.is_unknown(i) else t.replace(_SPACE, " ").encode()
        for i, t in enumerate(text)]
    keys = np.array(sorted(pairs), np.int64)
    return Vocabulary(decoded, lengths, _pack(chars), matched, alphabet, order, left, right, keys,
                      np.array([pairs[k] for k in keys], np.int64), bytes_at, size)


def _pack(chars: np.ndarray) -> np.ndarray:
    """Rows of characters as rows of keys of _PACK characters."""
    grouped = chars.reshape(len(chars), -1, _PACK)
    shifts = _BITS * np.arange(_PACK - 1, -1, -1)
    return (grouped << shifts).sum(axis=2)


def suffix_array(chars: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``width`` characters, and the packed keys of every position.

    Pieces are no longer than that, so their occurrences are contiguous without sorting any further.
    """
    padded = np.concatenate([chars, np.zeros(width + _PACK, np.int64)])
    key = np.zeros(len(chars) + width, np.int64)
    for k in range(_PACK):
        key = (key << _BITS) | padded[k:k + len(key)]
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    reach = _PACK
    while reach < width:
        pair = rank[:-reach] * (rank.max() + 1) + rank[reach:]
        rank = np.concatenate([np.unique(pair, return_inverse=True)[1].astype(np.int64), np.zeros(reach, np.int64)])
        reach *= 2
    return np.argsort(rank[:len(chars)]), key


def _bound(suffixes: np.ndarray, keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all pieces at once: first suffix that is not before (or is after) a packed text."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(suffixes))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = suffixes[np.minimum(middle, len(suffixes) - 1)]
        before, same = np.zeros(len(wanted), bool), np.ones(len(wanted), bool)
        for word in range(wanted.shape[1]):
            key = keys[at + word * _PACK]
            before |= same & (key < wanted[:, word])
            same &= key == wanted[:, word]
        if after:
            before |= same
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


def edges(chars: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences of pieces in a sequence, as (end, piece), by end and then from long to short."""
    width = vocabulary.keys.shape[1] * _PACK
    suffixes, keys = suffix_array(chars, width)
    lengths = vocabulary.lengths[vocabulary.matched]
    first = _bound(suffixes, keys, vocabulary.keys, after=False)
    # The last text that begins with a piece has the largest characters behind it.
    filler = np.where(np.arange(width) >= lengths[:, None], (1 << _BITS) - 1, 0)
    last = _bound(suffixes, keys, vocabulary.keys | _pack(filler), after=True)
    count = last - first
    shift = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    start = suffixes[np.arange(count.sum()) + shift]
    piece, length = np.repeat(vocabulary.matched, count), np.repeat(lengths, count)
    strange = np.flatnonzero(chars > len(vocabulary.alphabet))
    end = np.concatenate([start + length, strange + 1])
    piece = np.concatenate([piece, np.full(len(strange), vocabulary.unknown)])
    length = np.concatenate([length, np.ones(len(strange), np.int64)])
    by_end = np.argsort(end * 64 - length)
    return end[by_end], piece[by_end]


def stay_apart(left: np.ndarray, right: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Whether merging leaves two pieces side by side: undo the later merge on either side of the border, again
    and again; no merge across the border may come before the merge that was undone. Equal merges go from
    left to right."""
    fits = np.ones(len(left), bool)
    rows = np.flatnonzero((left != vocabulary.unknown) & (right != vocabulary.unknown) & (left >= 0))
    a, b = left[rows], right[rows]
    limit = np.full(len(rows), np.iinfo(np.int64).max)
    size = len(vocabulary.order)
    while len(rows):
        key = a * size + b
        at = np.minimum(np.searchsorted(vocabulary.pairs, key), len(vocabulary.pairs) - 1)
        crossing = (vocabulary.pairs[at] == key) & (vocabulary.pair_order[at] < limit)
        fits[rows[crossing]] = False
        when_a, when_b = vocabulary.order[a], vocabulary.order[b]
        go = ~crossing & ((when_a >= 0) | (when_b >= 0))
        rows, a, b, when_a, when_b = rows[go], a[go], b[go], when_a[go], when_b[go]
        on_left = when_a > when_b
        limit = np.where(on_left, when_a, when_b + 1)
        a, b = np.where(on_left, vocabulary.right[a], a), np.where(on_left, b, vocabulary.left[b])
    return fits


def encode_chunks(chunks: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all chunks, one after the other, and where those of each chunk begin."""
    joined = "\0".join(chunks) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    points = np.where(points == 0x20, ord(_SPACE), points)
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    numbers = np.full(0x110000, len(vocabulary.alphabet) + 1, np.uint16)
    numbers[vocabulary.alphabet] = np.arange(len(vocabulary.alphabet)) + 1
    chars = numbers[points].astype(np.int64)
    chars[starts + lengths] = 0  # the mark between chunks is no character of any piece
    end, piece = edges(chars, vocabulary)
    begin = np.concatenate([[0], np.cumsum(np.bincount(end, minlength=len(chars) + 1))])
    last, steps = np.full(len(chars) + 1, -1, np.int64), np.zeros(len(chars) + 1, np.int64)
    by_length = np.argsort(-lengths, kind="stable")
    longest_first = -lengths[by_length]
    for offset in range(1, int(lengths.max(initial=0)) + 1):
        open_ = by_length[:np.searchsorted(longest_first, -offset, side="right")]
        base, at = starts[open_], starts[open_] + offset
        edge = begin[at]
        while len(at):
            candidate = piece[edge]
            before = at - vocabulary.lengths[candidate]
            fits = stay_apart(np.where(before > base, last[before], -1), candidate, vocabulary)
            last[at[fits]] = candidate[fits]
            steps[at[fits]] = steps[before[fits]] + 1
            base, at, edge = base[~fits], at[~fits], edge[~fits] + 1
    count = steps[starts + lengths]
    count[lengths == 0] = 0
    offsets = np.concatenate([[0], np.cumsum(count)])
    found = np.empty(offsets[-1], np.int64)
    rows, at = np.flatnonzero(lengths > 0), (starts + lengths)[lengths > 0]
    while len(rows):
        found[offsets[rows] + steps[at] - 1] = last[at]
        at = at - vocabulary.lengths[last[at]]
        more = at > starts[rows]
        rows, at = rows[more], at[more]
    return _with_bytes(found, offsets, chunks, vocabulary)


def _with_bytes(found: np.ndarray, offsets: np.ndarray, chunks: list[str], vocabulary: Vocabulary):
    """Unknown characters as the pieces of their bytes."""
    strange = found == vocabulary.unknown
    if not strange.any():
        return found, offsets
    rows = np.unique(np.searchsorted(offsets, np.flatnonzero(strange), side="right") - 1)
    known = {chr(p) for p in vocabulary.alphabet} | {" "}
    replaced = {}
    for row in rows:
        unknown = (c for c in chunks[row] if c not in known)
        pieces = []
        for piece in found[offsets[row]:offsets[row + 1]]:
            if piece == vocabulary.unknown:
                pieces += [vocabulary.bytes_at + byte for byte in next(unknown).encode()]
            else:
                pieces.append(piece)
        replaced[row] = pieces
    count = np.diff(offsets)
    parts, done = [], 0
    for row in rows:
        parts += [found[offsets[done]:offsets[row]], np.array(replaced[row], np.int64)]
        count[row] = len(replaced[row])
        done = row + 1
    parts.append(found[offsets[done]:])
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(count)])


def alone(vocabulary: Vocabulary) -> np.ndarray:
    """Control characters that no piece holds: they part chunks."""
    marks = np.arange(256) < 0x20
    marks[vocabulary.alphabet[vocabulary.alphabet < 0x20]] = False
    return marks


def encode_batch(texts: pa.Array, vocabulary: Vocabulary) -> pa.ListArray:
    """Pieces of each text; a null or empty text has none."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    texts = pc.replace_substring(texts, _SPACE, " ")
    distinct, codes, rows = split_chunks(texts, alone(vocabulary))
    sizes = np.cumsum(pc.utf8_length(distinct).to_numpy() + 1)
    found, counts, done = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    while done < len(distinct):
        upto = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + INDEX_CHARS)))
        pieces, at = encode_chunks(distinct[done:upto].to_pylist(), vocabulary)
        found.append(pieces.astype(np.int32))
        counts.append(np.diff(at))
        done = upto
    found, counts = np.concatenate(found), np.concatenate(counts)
    at = np.cumsum(counts) - counts
    # Chunk by chunk back to the texts, some at a time.
    out = []
    for low in range(0, len(codes), 1 << 18):
        code = codes[low:low + (1 << 18)]
        count = counts[code]
        shift = np.repeat(at[code] - (np.cumsum(count) - count), count)
        out.append(found[shift + np.arange(len(shift))])
    total = np.concatenate([[0], np.cumsum(counts[codes])])
    return pa.ListArray.from_arrays(pa.array(total[rows], pa.int32()), pa.array(np.concatenate(out or [found])))


def decode_batch(ids: pa.ListArray, vocabulary: Vocabulary) -> pa.Array:
    """Texts of lists of pieces: the leading space goes, bytes that are no UTF-8 become U+FFFD; null stays null."""
    pieces = pa.array(vocabulary.pieces, pa.large_binary())
    parts = pieces.take(ids.flatten())
    ends = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset:parts.offset + len(parts) + 1]
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    at = ends[np.concatenate([[0], np.cumsum(lengths)])]
    data = parts.buffers()[2]
    starts = at[:-1]
    if data is not None and len(data):
        raw = np.frombuffer(data, np.uint8)
        spaced = (at[1:] > starts) & (raw[np.minimum(starts, len(raw) - 1)] == 0x20)
        starts = starts + spaced
    view = memoryview(data) if data is not None else memoryview(b"")
    texts = [bytes(view[a:b]).decode("utf-8", "replace") for a, b in zip(starts, at[1:], strict=True)]
    return pa.array(texts, pa.string(), mask=~ids.is_valid().to_numpy(zero_copy_only=False))


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "pieces") -> DataFrame:
    """The rows with the pieces of a text column in a new column (array of int; replaced if it exists).

    A null or empty text gives an empty list; repeated rows, other columns and their order stay as they are.
    Texts are encoded whole, with SentencePiece's leading space, and U+2581 counts as a space. A batch is
    worked off in parts of about SLICE_BYTES; a single longer text is one part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.__dict__)
    docs = docs.drop(out)
    schema = docs.withColumn(out, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(**shared.value)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                pieces = encode_batch(part.column(text), vocabulary)
                yield pa.RecordBatch.from_arrays([*part.columns, pieces], names=[*part.schema.names, out])
            give_back()

    return docs.mapInArrow(run, schema)


def decode_digest(encoded: DataFrame, vocabulary: Vocabulary, text: str = "text", pieces: str = "pieces") -> DataFrame:
    """Per row: doc_id, number of pieces, digest of their numbers (32 bit, little endian), whether decoding gives
    the text again (null counts as empty)."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.__dict__)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(**shared.value)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                ids = part.column(pieces)
                decoded = decode_batch(ids, vocabulary)
                same = pc.equal(decoded, pc.fill_null(part.column(text), ""))
                numbers = np.ascontiguousarray(ids.flatten().to_numpy(), "<i4")
                counts = pc.list_value_length(ids)
                ends = np.cumsum(counts.to_numpy())
                digests = [hashlib.sha256(numbers[b - n:b].tobytes()).hexdigest()
                           for b, n in zip(ends, counts.to_numpy(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), counts.cast(pa.int64()), pa.array(digests, pa.string()), same],
                    names=["doc_id", "n_pieces", "pieces_sha256", "round_trip"])
            give_back()

    return encoded.select("doc_id", text, pieces).mapInArrow(
        run, "doc_id bigint, n_pieces bigint, pieces_sha256 string, round_trip boolean")
