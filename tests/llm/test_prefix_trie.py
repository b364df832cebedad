"""The prefix trie against a plain one, with all splits of the decomposition."""

import hashlib
import random
import zlib

import pytest

from stormglass.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, node string"


def plain_order(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(found, key=lambda x: (x[0], x[1].encode(), x[2].encode()))] for c, found in turns.items()}


def plain_trie(sequences):
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    rows = {}
    for path, found in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) == len(p) + 1 for q in below)]
        ends = sorted(c for c in found if len(sequences[c]) == len(path))
        rows[min(found), len(path)] = (
            min(members[path[:-1]]) if path else None, len(found), len(children), len(leaves),
            sum((len(members[p]) - 1) * len(p[-1][1] if p else "") for p in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return rows


def result(frame):
    rows = frame.collect()
    found = {(r["conv_id"], r["depth"]): tuple(r[2:]) for r in rows}
    assert len(found) == len(rows)
    return found


def some_rows(seed, conversations, longest, words):
    pick = random.Random(seed)
    rows = []
    for conv in range(conversations):
        said = [(pick.choice(["user", "assistant"]), pick.choice(words)) for _ in range(pick.randint(1, longest))]
        rows += [(conv * 7, turn, role, text) for turn, (role, text) in enumerate(said)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [1, 3, 20, 10_000])
def test_trie_is_the_plain_one(make, scratch, small, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    rows = some_rows(small, 40, 9, ["a", "bé", ""])
    turns = make([(*r, 1, "x") for r in rows], SCHEMA)
    assert result(prefix_trie.conversation_trie(turns, scratch, small=small)) == plain_trie(plain_order(rows))


def test_one_long_chain(make, scratch):
    rows = [(5, k, "user", f"t{k}") for k in range(60)] + [(9, k, "user", f"t{k}") for k in range(31)]
    found = result(prefix_trie.conversation_trie(make([(*r, 1, "x") for r in rows], SCHEMA), scratch, small=2))
    assert found == plain_trie(plain_order(rows))


def test_nulls_ties_repeats_and_heads(make, scratch):
    rows = [
        (100, None, "user", "hi"), (100, 1, None, None), (100, 1, None, None), (100, 1, "user", "b"), (100, 1, "user", "a"),
        (101, 3, "user", "own"), (102, 1, "", ""), (102, 2, "user", "x" * 5000), (250, 0, "user", "hi"), (251, 0, None, "hi"),
        (None, 0, "user", "nobody"), (-3, 0, "user", "hi"), (-3, 1, "user", "more"),
    ]
    turns = make([(*r, 1, "x") for r in rows], SCHEMA)
    own = plain_order(rows)
    rebuilt = {}
    for conv, said in own.items():
        base = conv - int(conv - 100 * int(conv / 100)) if conv >= 0 else -(-conv - (-conv) % 100)
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = own.get(base, [])[:h] + said[h:]
    assert any(not said for said in rebuilt.values())
    found = result(prefix_trie.conversation_trie(turns, scratch, prefix_trie.block_heads(turns)))
    assert found == plain_trie(rebuilt)
    assert result(prefix_trie.conversation_trie(turns, scratch)) == plain_trie(own)


def test_empty_table(make, scratch):
    turns = make([], SCHEMA)
    assert result(prefix_trie.conversation_trie(turns, scratch, prefix_trie.block_heads(turns))) == {}


def test_roles_and_texts_do_not_run_into_each_other(make, scratch):
    rows = [(1, 0, "ab", "c", 1, "x"), (2, 0, "a", "bc", 1, "x")]
    assert len(result(prefix_trie.conversation_trie(make(rows, SCHEMA), scratch))) == 3
