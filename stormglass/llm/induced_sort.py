"""Suffix sorting by induction, with common prefixes, on queues that go to disk when they are large.

A suffix is of type S if it is smaller than the next one, else of type L; an S suffix behind an L one is a mark. Sorted
marks give the order of all L suffixes by one pass over a queue, and those the order of all S suffixes by another. The order of
the marks comes from the same two passes over unsorted marks, which sort the stretches between them, and from a recursion on the
text of their ranks, down to a text that is short enough to be sorted plainly. A queue hands out tuples of place and common prefix by first symbol and, among equal ones, by
arrival; as the number of tuples of each symbol is known, it is one long array that is written and read in order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

_NONE = -1


class Room:
    """Arrays of a task: in memory up to ``most`` bytes each, larger ones in files that go with the task.

    batch: tuples that are worked on at once; base: marks up to which the recursion ends in a plain sort.
    """

    def __init__(self, most: int = 1 << 26, batch: int = 1 << 16, base: int = 1 << 20):
        self.most, self.batch, self.base = most, batch, base
        self.on_disk = 0

    def empty(self, n: int, kind) -> np.ndarray:
        if n * np.dtype(kind).itemsize <= self.most:
            return np.empty(n, kind)
        self.on_disk += 1
        with tempfile.TemporaryFile() as file:  # without a name; the mapping holds it
            return np.memmap(file, kind, "w+", shape=(n,))

    def full(self, n: int, kind, value) -> np.ndarray:
        made = self.empty(n, kind)
        for at in range(0, n, self.batch):
            made[at:at + self.batch] = value
        return made

    def parts(self, n: int) -> Iterator[slice]:
        for at in range(0, n, self.batch):
            yield slice(at, min(n, at + self.batch))

    def parts_backwards(self, n: int) -> Iterator[slice]:
        for at in range(n, 0, -self.batch):
            yield slice(max(0, at - self.batch), at)


def _place_kind(n: int):
    return np.int32 if n < 1 << 31 else np.int64


def rising(text: np.ndarray, n: int, room: Room) -> np.ndarray:
    """Whether each suffix is of type S. The last symbol is smaller than all others and its suffix of type S."""
    found = room.empty(n, bool)
    found[n - 1] = True
    following = True  # type of the suffix behind the part
    for part in room.parts_backwards(n - 1):
        here, behind = text[part], text[part.start + 1:part.stop + 1]
        differ = np.flatnonzero(here != behind)
        up = here[differ] < behind[differ]
        ends = np.append(differ, len(here) - 1)
        types = np.append(up, following)
        found[part] = np.repeat(types, np.diff(np.concatenate([[-1], ends])))
        following = bool(found[part.start])
    return found


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to cap. The text is followed by 8 more symbols of one byte."""
    found = np.zeros(len(a), np.int64)
    at = np.arange(len(a))
    reach = np.arange(8)
    done = 0
    while len(at) and done < cap:
        x = np.ascontiguousarray(text[(a[at] + done)[:, None] + reach]).view("<u8").ravel()
        x = x ^ np.ascontiguousarray(text[(b[at] + done)[:, None] + reach]).view("<u8").ravel()
        same = x == 0
        low = x[~same]
        low &= np.uint64(0) - low
        found[at[~same]] = done + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        at = at[same]
        done += 8
    found[at] = cap
    return np.minimum(found, cap)


class SuffixQueue:
    """Tuples of place and common prefix, handed out by first symbol, then by arrival: pushed ones before given ones.

    cap: common prefixes are counted up to it; None leaves them out. Each is that with the tuple handed out before.
    """

    def __init__(self, pushed: np.ndarray, given: np.ndarray, ascending: bool, room: Room, cap: int | None):
        sizes = (pushed + given) if ascending else (pushed + given)[::-1]
        start = np.cumsum(sizes) - sizes
        self.start = start if ascending else start[::-1]
        self.size = int(sizes.sum())
        self.next_pushed, self.next_given = self.start.copy(), self.start + pushed
        self.borders = np.sort((self.start + pushed)[(pushed > 0) & (given > 0)])
        self.place = room.full(self.size, _place_kind(self.size), _NONE)
        self.cap, self.room = cap, room
        if cap is not None:
            self.common = room.empty(self.size, np.uint8)
            self.least = np.full(len(pushed), cap, np.uint8)  # since the last push for each symbol

    def _append(self, heads: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the tuples by symbol, their slots, and which are the first of their symbol."""
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order]
        first = np.ones(len(symbols), bool)
        first[1:] = symbols[1:] != symbols[:-1]
        at = np.flatnonzero(first)
        counts = np.diff(np.append(at, len(symbols)))
        which = symbols[at]
        slots = np.repeat(heads[which] - at, counts) + np.arange(len(symbols))
        heads[which] += counts
        return order, slots, first

    def give(self, places: np.ndarray, symbols: np.ndarray, common: np.ndarray | None = None) -> None:
        order, slots, _ = self._append(self.next_given, symbols)
        self.place[slots] = places[order]
        if common is not None:
            self.common[slots] = common[order]

    def run(self, text: np.ndarray, wanted: np.ndarray, rises: bool) -> None:
        """Hand out all tuples; each pushes the suffix before its own, if that is of the wanted type."""
        at, step = 0, 1024
        while at < self.size:
            batch = self.place[at:at + step]
            empty = np.flatnonzero(batch == _NONE)
            # Tuples up to the first missing one depend on none behind them.
            size = int(empty[0]) if len(empty) else len(batch)
            step = min(self.room.batch, max(1024, 2 * size))
            batch = np.asarray(batch[:size]).astype(np.int64)
            before = batch - 1
            push = before >= 0
            push[push] = wanted[before[push]] == rises
            if self.cap is not None:
                self._measure_borders(text, at, size)
            if push.any():
                self._push(text, at, size, before, np.flatnonzero(push))
            elif self.cap is not None:
                self.least = np.minimum(self.least, self.common[at:at + size].min())
            at += size

    def _measure_borders(self, text: np.ndarray, at: int, size: int) -> None:
        here = self.borders[np.searchsorted(self.borders, at):np.searchsorted(self.borders, at + size)]
        if len(here):
            ends = self.place[here].astype(np.int64), self.place[here - 1].astype(np.int64)
            self.common[here] = common_prefix(text, *ends, self.cap)

    def _push(self, text: np.ndarray, at: int, size: int, before: np.ndarray, pushing: np.ndarray) -> None:
        symbols = text[before[pushing]]
        heads = self.next_pushed.copy() if self.cap is not None else None
        order, slots, first = self._append(self.next_pushed, symbols)
        self.place[slots] = before[pushing[order]]
        if self.cap is None:
            return
        k, symbol = pushing[order], symbols[order]
        common = np.asarray(self.common[at:at + size])
        found = np.empty(len(k), np.uint8)
        found[first] = np.minimum(self.least[symbol[first]], np.minimum.accumulate(common)[k[first]])
        later = np.flatnonzero(~first)
        found[later] = _range_least(common, k[later - 1] + 1, k[later])
        found = np.minimum(found, np.uint8(self.cap - 1)) + np.uint8(1)
        found[first] = np.where(heads[symbol[first]] == self.start[symbol[first]], 0, found[first])
        self.common[slots] = found
        behind = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(self.cap))
        self.least = np.minimum(self.least, behind[0])
        last = np.append(np.flatnonzero(first)[1:], len(k)) - 1
        self.least[symbol[last]] = behind[k[last] + 1]


def _range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high], ends included."""
    out = np.empty(len(low), values.dtype)
    if not len(low):
        return out
    level = np.log2((high - low + 1).astype(np.float32)).astype(np.int8)
    order = np.argsort(level, kind="stable")
    ends = np.searchsorted(level[order], np.arange(int(level.max()) + 2))
    table = values
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        here = order[a:b]
        out[here] = np.minimum(table[low[here]], table[high[here] - (1 << k) + 1])
        table = np.minimum(table[:-(1 << k)], table[1 << k:]) if len(table) > 1 << k else table
    return out


def _induced(text, n, rises, counts_l, counts_s, marks, room, cap) -> SuffixQueue:
    """The queue that has handed out all suffixes, largest first; marks: parts of marks in order, with common prefixes."""
    counts_m = np.zeros(len(counts_l), np.int64)
    for places in marks():
        counts_m += np.bincount(text[places], minlength=len(counts_l))
    falling = SuffixQueue(counts_l, counts_m, True, room, cap)
    last = None
    for places in marks():
        common = None
        if cap is not None:
            others = places[:-1] if last is None else np.append(last, places[:-1])
            common = common_prefix(text, places[len(places) - len(others):], others, cap)
            common = np.concatenate([np.zeros(len(places) - len(others), np.int64), common])
            last = places[-1]
        falling.give(places, text[places], common)
    falling.run(text, rises, False)
    rising_queue = SuffixQueue(counts_s, counts_l, False, room, cap)
    # The last suffix is pushed by none.
    rising_queue.place[rising_queue.next_pushed[text[n - 1]]] = n - 1
    if cap is not None:
        rising_queue.common[rising_queue.next_pushed[text[n - 1]]] = 0
    rising_queue.next_pushed[text[n - 1]] += 1
    above = 0
    for part in room.parts_backwards(falling.size):
        places = np.asarray(falling.place[part])[::-1].astype(np.int64)
        common = None
        if cap is not None:
            shared = np.asarray(falling.common[part])[::-1]
            common = np.concatenate([[above], shared[:-1]])
            above = shared[-1]
        kept = ~rises[places]
        rising_queue.give(places[kept], text[places[kept]], None if common is None else common[kept])
    rising_queue.run(text, rises, True)
    return rising_queue


def _sorted(text: np.ndarray, n: int, symbols: int, room: Room, cap: int | None) -> SuffixQueue:
    rises = rising(text, n, room)
    counts_l, counts_s, n_marks = np.zeros(symbols, np.int64), np.zeros(symbols, np.int64), 0

    def marks_of(part: slice) -> np.ndarray:
        low = max(1, part.start)
        return low + np.flatnonzero(rises[low:part.stop] & ~rises[low - 1:part.stop - 1])

    for part in room.parts(n):
        up = rises[part]
        here = text[part]
        counts_s += np.bincount(here[up], minlength=symbols)
        counts_l += np.bincount(here[~up], minlength=symbols)
        n_marks += len(marks_of(part))
    kind = _place_kind(n)
    marks = room.empty(n_marks, kind)
    done = 0
    for part in room.parts(n):
        found = marks_of(part)
        marks[done:done + len(found)] = found
        done += len(found)

    def unsorted() -> Iterator[np.ndarray]:
        for part in room.parts(n_marks):
            yield np.asarray(marks[part]).astype(np.int64)

    ranked = _induced(text, n, rises, counts_l, counts_s, unsorted, room, None)
    rank, ranks = _ranked_stretches(text, n, ranked, rises, marks, room)
    del ranked
    if ranks < n_marks and n_marks > room.base:
        deeper = _sorted(rank, n_marks, ranks, room, None)
        order = deeper.place

        def in_order() -> Iterator[np.ndarray]:
            for part in room.parts_backwards(n_marks):
                yield marks[np.asarray(order[part])[::-1]].astype(np.int64)
    else:
        if ranks < n_marks:
            order = _plainly_sorted(np.asarray(rank).astype(np.int64))
        else:
            order = room.empty(n_marks, kind)
            for part in room.parts(n_marks):
                order[rank[part]] = np.arange(part.start, part.stop)

        def in_order() -> Iterator[np.ndarray]:
            for part in room.parts(n_marks):
                yield marks[np.asarray(order[part])].astype(np.int64)

    return _induced(text, n, rises, counts_l, counts_s, in_order, room, cap)


def _plainly_sorted(rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a short text of ranks, by pairs of ranks of fronts twice as long in each round."""
    n, width = len(rank), 1
    while True:
        behind = np.zeros(n, np.int64)
        behind[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + behind
        # Equal keys get equal ranks, so their order does not matter.
        order = np.argsort(key)
        key = key[order]
        new = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        width *= 2


def _ranked_stretches(text, n, ranked: SuffixQueue, rises, marks, room: Room) -> tuple[np.ndarray, int]:
    """Rank of the stretch from each mark to the next, equal for equal ones, in the order of the text."""
    kind = _place_kind(n)
    at_half = room.empty(n // 2 + 1, kind)  # marks are at least two apart
    length = room.empty(n // 2 + 1, kind)
    for part in room.parts(len(marks)):
        here = np.asarray(marks[part]).astype(np.int64)
        behind = np.asarray(marks[part.start + 1:part.stop + 1]).astype(np.int64)
        behind = np.append(behind, n - 1)[:len(here)]
        length[here >> 1] = behind - here
    name, last = -1, None
    for part in room.parts_backwards(ranked.size):
        places = np.asarray(ranked.place[part])[::-1].astype(np.int64)
        marked = rises[places] & (places > 0)
        marked[marked] = ~rises[places[marked] - 1]
        places = places[marked]
        if not len(places):
            continue
        others = np.concatenate([places[:1] if last is None else [last], places[:-1]])
        new = ~_equal_stretches(text, places, others, length)
        if last is None:
            new[0] = True
        names = name + np.cumsum(new)
        at_half[places >> 1] = names
        name, last = int(names[-1]), places[-1]
    rank = room.empty(len(marks), kind)
    for part in room.parts(len(marks)):
        rank[part] = at_half[np.asarray(marks[part]) >> 1]
    return rank, name + 1


def _equal_stretches(text, a, b, length) -> np.ndarray:
    size = np.asarray(length[a >> 1]).astype(np.int64)
    equal = size == length[b >> 1]
    at = np.flatnonzero(equal)
    step = 0
    while len(at):
        differ = text[a[at] + step] != text[b[at] + step]
        equal[at[differ]] = False
        at = at[~differ]
        at = at[size[at] > step]
        step += 1
    return equal


def suffixes(text: np.ndarray, n: int, cap: int, room: Room) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of a text, largest first, in parts: places, and common prefixes (up to cap) with the one before.

    text: bytes, n of them and 8 more; the last of the n is smaller than all others. cap: at most 255.
    """
    if n == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.int64)
        return
    queue = _sorted(text, n, 256, room, cap)
    for part in room.parts(n):
        yield np.asarray(queue.place[part]).astype(np.int64), np.asarray(queue.common[part]).astype(np.int64)
