"""Texts of Arrow batches cut into chunks that are told apart, and batches cut into parts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def give_back() -> None:
    """Return memory that a task has freed to the system: workers stay alive between tasks, beside other ones."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` bytes in a column; a longer value is a part of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    done = 0
    while done < batch.num_rows:
        upto = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + limit, side="right")))
        yield batch.slice(done, upto - done)
        done = upto


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (and the last ends)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def distinct_parts(data: np.ndarray, begins: np.ndarray, ends: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Different parts of a byte sequence that is cut where ``begins`` says, and the number of each part's value."""
    offsets = pa.array(np.append(begins, len(data)), pa.int64())
    parts = pa.Array.from_buffers(pa.large_string(), len(begins), [None, offsets.buffers()[1], pa.py_buffer(data)])
    coded = parts.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def split_chunks(texts: pa.Array, alone: np.ndarray, any_space: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different chunks, the number of each chunk in order, and where the chunks of each text begin.

    A space is put before each text that is not empty. A chunk begins at a space behind another
    character, at and after the bytes that ``alone`` marks, and at each text. any_space: ASCII white space counts as space.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
    data, starts = text_bytes(texts)
    if any_space:
        data = np.where((data >= 9) & (data <= 13), np.uint8(0x20), data)
    space, control = data == 0x20, alone[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (space[1:] & ~space[:-1]) | control[1:] | control[:-1]
    cut[starts] = True
    cut[len(data)] = False
    bounds = np.flatnonzero(cut)
    distinct, codes = distinct_parts(data, bounds)
    return distinct, codes, np.searchsorted(bounds, starts)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words (what ASCII white space parts, as bytes), the number of each word in order, and where the
    words of each text begin (and the last ones end). Null texts have none."""
    data, starts = text_bytes(texts)
    inside = (data != 0x20) & ((data < 9) | (data > 13))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = starts[:-1][starts[:-1] < starts[1:]]
    begins[first] = inside[first]
    at = np.flatnonzero(begins)
    places = np.cumsum(inside)[at] - 1
    offsets = pa.array(np.append(places, int(inside.sum())), pa.int64())
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, offsets.buffers()[1], pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(at, starts)
