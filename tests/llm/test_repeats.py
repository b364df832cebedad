"""Suffix sorting against a plain sort, and repeated passages against a plain search."""

import random

import numpy as np
import pytest
import xxhash

from stormglass.llm import repeats
from stormglass.llm.induced_sort import Room, suffixes

SCHEMA = "doc_id bigint, text string, source string, rank int, r string, kept2 int"


def plain_suffixes(body, cap):
    text = body + b"\0"
    order = sorted(range(len(text)), key=lambda i: text[i:], reverse=True)

    def common(i, j):
        n = 0
        while n < cap and text[i + n:i + n + 1] == text[j + n:j + n + 1] and i + n < len(text) and j + n < len(text):
            n += 1
        return n

    return order, [0] + [common(i, j) for i, j in zip(order[1:], order, strict=False)]


@pytest.mark.parametrize("most, batch", [(16, 1), (16, 7), (1 << 20, 2), (1 << 20, 1024)])
def test_suffixes_and_common_prefixes(most, batch):
    pick = random.Random(most + batch)
    for _ in range(300):
        letters = pick.choice([1, 2, 3, 5, 200])
        body = bytes(pick.randint(1, letters) for _ in range(pick.randint(0, 60))) * pick.randint(1, 3)
        cap, room = pick.choice([3, 50, 255]), Room(most, batch, base=pick.choice([0, 5, 1000]))
        text = np.concatenate([np.frombuffer(body, np.uint8), np.zeros(9, np.uint8)])
        parts = list(suffixes(text, len(body) + 1, cap, room))
        found = [x.tolist() for x in map(np.concatenate, zip(*parts, strict=True))]
        assert tuple(found) == plain_suffixes(body, cap)
        assert (room.on_disk > 0) == (most == 16 and len(body) > 3) or len(body) < 20


def test_hashes_are_made_for_a_block_at_once(monkeypatch):
    pick = random.Random(5)
    data = np.frombuffer(bytes(pick.randint(97, 110) for _ in range(3000)), np.uint8)
    [block] = repeats.stretches(data, np.array([0, 1000, 1000, 1020, 3000]), 50)
    head, tail = block.units()
    bodies = [data[a:b + 50].tobytes() for a, b in zip(block.first[head], block.last[tail], strict=True)]
    numbers = [xxhash.xxh3_128_intdigest(x) for x in bodies]
    plain = [xxhash.xxh3_64_intdigest(x) for x in bodies]

    def one_by_one(body):
        raise AssertionError("a Python number for each hash costs more than the hash")

    for name in ("xxh3_128_intdigest", "xxh3_64_intdigest"):
        monkeypatch.setattr(xxhash, name, one_by_one)
    low, high = repeats._unit_hashes(data, block, 50)
    assert [int(x) << 64 | int(y) for x, y in zip(high.view(np.uint64), low.view(np.uint64), strict=True)] == numbers
    assert repeats._text_hashes(bodies).view(np.uint64).tolist() == plain
    assert len(bodies) > 10
    assert len(repeats._text_hashes([])) == 0


def plain(rows, length):
    order = [float("inf") if doc is None else doc for doc, _ in rows]
    bodies = [(text or "").encode() for _, text in rows]
    first = {}
    for rank, body in zip(order, bodies, strict=True):
        for i in range(len(body) - length + 1):
            gram = body[i:i + length]
            first[gram] = min(rank, first.get(gram, rank))
    found = []
    for (doc, _), rank, body in zip(rows, order, bodies, strict=True):
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            if first[body[i:i + length]] < rank:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        found.append((doc, len(body), sum(gone), runs, bytes(b for b, x in zip(body, gone, strict=True) if not x)))
    return sorted(found, key=str)


def found(make, scratch, rows, length=repeats.LENGTH, **more):
    docs = make([(*r, "s", 1, "x", 2) for r in rows], SCHEMA)
    result = repeats.remove_repeats(docs, scratch, length, **more)
    assert result.columns == [*docs.columns, "kept", "n_bytes", "n_removed", "n_spans"]
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in result.collect()), key=str)


@pytest.mark.parametrize("length, letters, shard, most", [(4, "ab", 40, 64), (7, "abc é", 10_000, 1 << 20), (20, "ab", 300, 256)])
def test_random_texts(make, scratch, length, letters, shard, most):
    pick = random.Random(length)
    pool = ["".join(pick.choice(letters) for _ in range(pick.randint(1, 60))) for _ in range(15)]
    rows = [(pick.randint(0, 60), "".join(pick.choice(pool) for _ in range(pick.randint(0, 4)))) for _ in range(80)]
    assert found(make, scratch, rows, length, shard_bytes=shard, room=Room(most, 50, base=9)) == plain(rows, length)


def test_odd_documents(make, scratch, monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK", 100)
    passage = "The licence of this text, which many documents share, is à la carte; 日本語。 " * 2
    rows = [
        (1, passage), (2, "before " + passage + " after"), (2, "again 2 " + passage), (None, "null " + passage), (None, passage),
        (3, None), (4, ""), (5, "a" * 49), (6, "a" * 50), (7, "a" * 500), (8, "a" * 51), (9, "x" + passage[:49]), (10, "x" + passage[:60]),
        (2, "before " + passage + " after"), (-5, "late " + passage[3:80]), (11, " ".join(map(str, range(4000)))),
        (12, "12 " + " ".join(map(str, range(3900)))), (13, passage + "unique" + passage),
    ]
    assert found(make, scratch, rows) == plain(rows, repeats.LENGTH)


def test_empty_table_and_texts(make, scratch):
    assert found(make, scratch, []) == []
    assert found(make, scratch, [(1, None), (2, "")]) == [(1, 0, 0, 0, b""), (2, 0, 0, 0, b"")]
