import random

import numpy as np
import pyarrow as pa
import pytest

from stormglass.llm import weighted_minhash
from stormglass.llm.components import connected


def test_components_of_paths_stars_and_rings(make, scratch):
    draw = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(200 + k, 200 + (k + 1) % 9) for k in range(9)]
    edges += [(300, 300), (None, 5), (7, None), (1, 0), (0, 1)]
    names = list(range(400))
    draw.shuffle(names)
    frame = make([(None if a is None else names[a], None if b is None else names[b]) for a, b in edges], "a bigint, b bigint")
    found = {r.vertex: r.component for r in connected(frame, scratch).collect()}
    for group in (range(0, 61), range(100, 180), range(200, 209)):
        least = min(names[k] for k in group)
        assert all(found[names[k]] == least for k in group)
    assert len(found) == 61 + 80 + 9
    assert connected(make([], "a bigint, b bigint"), scratch).count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    draws = weighted_minhash.Draws.make(3000)
    random_ = np.random.default_rng(4)
    value = random_.integers(1 << 63, size=60, dtype=np.uint64)
    left, right = np.sort(value[:45]), np.sort(value[15:])
    weights = {v: w for v, w in zip(value.tolist(), random_.uniform(0.5, 4, 60), strict=True)}
    wl, wr = (np.array([weights[v] for v in x.tolist()]) for x in (left, right))
    wr = wr * np.where(np.isin(right, left), 1.3, 1.0)
    got = weighted_minhash.samples(np.concatenate([left, right]), np.concatenate([wl, wr]), np.array([0, 45, 90]), draws)
    a, b = dict(zip(left.tolist(), wl, strict=True)), dict(zip(right.tolist(), wr, strict=True))
    keys = set(a) | set(b)
    expected = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    assert (got[0] == got[1]).mean() == pytest.approx(expected, abs=0.03)


def test_shingles_are_five_words():
    texts = ["a b c d e f", "A  b\tc d e", "a b c", "", None, "a a a a a a a"]
    value, times, begins = weighted_minhash.shingles(pa.array(texts, pa.string()))
    assert np.diff(begins).tolist() == [2, 1, 1, 0, 0, 1]
    assert times[-1] == 3 and value[begins[1]] in value[:2]


def words(draw, n):
    return [draw.choice("abcdefghijklmnop") + str(draw.randrange(3000)) for _ in range(n)]


def test_planted_copies_and_nothing_else(documents, scratch):
    draw = random.Random(9)
    rows, truth = [], {}

    def add(text, group):
        truth[len(rows)] = group
        rows.append((len(rows), text, "s"))

    passage = words(draw, 60)
    for k in range(80):
        add(" ".join(words(draw, 200)), f"single{k}")
    for k in range(40):  # a passage that many share is no copy
        add(" ".join(words(draw, 120) + passage + words(draw, 60)), f"shares{k}")
    for k in range(12):
        base = words(draw, 300)
        for _ in range(k + 2):
            near = list(base)
            near[draw.randrange(300)] = "changed"
            add(" ".join(near), f"near{k}")
    for _ in range(90):
        add("one text that is there many times over", "copies")
    add("short", "short")
    add("short", "short")
    got = {r.doc_id: r for r in weighted_minhash.near_documents(documents(rows), scratch).collect()}
    first = {}
    for k, group in truth.items():
        first.setdefault(group, k)
    assert {k: r.class_id for k, r in got.items()} == {k: first[g] for k, g in truth.items()}
    assert {k for k, r in got.items() if r.kept} == set(first.values())


def test_odd_rows_and_one_of_each_group_stays(documents, scratch):
    same = "one two three four five six"
    rows = [(1, None, "s"), (2, None, "s"), (3, "", "s"), (4, " \n", "s"), (5, same, "s"), (5, same, "s"), (6, same, None), (None, same, "s"),
            (7, "w " * 100000, "s"), (1, None, "s")]
    frame = documents(rows)
    got = weighted_minhash.near_documents(frame, scratch).collect()
    assert len(got) == len(rows)
    assert {r.class_id for r in got if r.doc_id in (5, 6, None)} == {5}
    assert all(r.kept and r.class_id == r.doc_id for r in got if r.doc_id in (1, 2, 3, 4, 7))
    left = weighted_minhash.keep_one(frame, scratch)
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 4, 5, 7]
    assert weighted_minhash.near_documents(documents([]), scratch).count() == 0
    assert weighted_minhash.keep_one(documents([]), scratch).count() == 0


def test_pairs_in_large_buckets_of_a_template(documents, scratch, monkeypatch):
    monkeypatch.setattr(weighted_minhash, "FEW_LINKS", 1.0)  # as with very many links elsewhere
    draw = random.Random(12)
    template, rows = words(draw, 254), []
    for _ in range(200):
        own = words(draw, 14)
        rows += [(len(rows) + k, " ".join(template + own + words(draw, 13)), "s") for k in range(2)]
    got = {r.doc_id: r.class_id for r in weighted_minhash.near_documents(documents(rows), scratch).collect()}
    assert sum(got[k] != k - k % 2 for k in range(400)) <= 4  # candidates share a band and 17 samples by chance


def test_similar_texts_share_an_early_rare_shingle(make):
    draw = random.Random(5)
    base = words(draw, 80)
    rows = [(k, " ".join(base[:80 - draw.randrange(12)] + words(draw, draw.randrange(12)))) for k in range(40)]
    idf = np.random.default_rng(1).uniform(1, 2, weighted_minhash.CELLS).astype(np.float32)
    found = {}
    for r in weighted_minhash.rare_shingles(make(rows, "cls bigint, text string"), idf, 0.8).collect():
        found.setdefault(r.cls, {})[r.token] = r
    pairs = [(*a, *b) for a in rows for b in rows if a[0] < b[0]]
    pairs = make(pairs, "a bigint, text_a string, b bigint, text_b string")
    similar = [r for r in weighted_minhash.similarities(pairs, idf).collect() if r.similarity >= 0.8]
    assert len(similar) > 50
    for r in similar:
        a, b = found[r.a], found[r.b]
        assert any(min(a[t].rest, b[t].rest) >= 0.8 / 1.8 * (a[t].total + b[t].total) - 1e-6 for t in a.keys() & b.keys())


def test_texts_of_a_family_that_are_not_similar_make_no_pairs(make, scratch):
    draw = random.Random(7)
    base = words(draw, 204)
    idf = np.ones(weighted_minhash.CELLS, np.float32)
    rows = []
    for k in range(60):  # four own words at places of their own: the first shingle that two have in common says little
        own = list(base)
        for place in draw.sample(range(10, 190), 4):
            own[place] = f"own{k}x{place}"
        rows.append((k, k, " ".join(own)))
    near = [*base[:190], *words(draw, 14)]
    rows += [(60, 60, " ".join(near)), (61, 61, " ".join([*near[:-1], "last"]))]
    frame = make(rows, "cls bigint, component bigint, text string")
    texts = make([(*a[::2], *b[::2]) for a in rows for b in rows if a[0] < b[0]], "a bigint, text_a string, b bigint, text_b string")
    found = {(r.a, r.b): r.similarity for r in weighted_minhash.similarities(texts, idf).collect()}
    tokens, sketched = weighted_minhash.rare_shingles(frame, idf, 0.8), weighted_minhash.sketches(frame, idf)
    got = {tuple(r) for r in weighted_minhash._sharing_rare(tokens, sketched, 0.8, scratch).collect()}
    similar = {p for p, x in found.items() if x >= 0.8}
    assert (60, 61) in similar and similar <= got
    assert len(got) < len(found) / 4
    parts = {r.of_cls: np.array(r.sketch) for r in sketched.collect()}
    for (a, b), x in found.items():
        total = parts[a].sum() + parts[b].sum()
        assert np.abs(parts[a] - parts[b]).sum() <= (1 - x) / (1 + x) * total + 1e-3
