import numpy as np
import pytest
from pyspark.sql import functions as F

import checks
from stormglass.llm import sorted_passes, vp_search

SCHEMA = "vec_id bigint, embedding array<float>, label int, size int, key string"


def cosines(rows):
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    return units @ units.T


@pytest.fixture(scope="module")
def corpus():
    """Near groups of several sizes, pairs, exact copies and single vectors, in two labels."""
    draw = np.random.default_rng(7)
    rows, labels = [], []
    for size in (150, 40, 2, 2, 2, 2, 2, 2):
        centre = draw.standard_normal(32)
        rows += [centre + draw.standard_normal(32) * 0.08 for _ in range(size)]
        labels += [0] * size
    rows += [draw.standard_normal(32) for _ in range(300)]
    labels += [k % 2 for k in range(300)]
    rows += [rows[0]] * 30 + [rows[-1]] * 200
    labels += [0] * 30 + [labels[-1]] * 200
    return np.array(rows, np.float32), labels


def test_links_and_components_by_brute_force(make, scratch, corpus):
    rows, labels = corpus
    frame = make([(k, [float(x) for x in r], l, 1, "x") for k, (r, l) in enumerate(zip(rows, labels, strict=True))], SCHEMA)
    linked = (cosines(rows.astype(float)) >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(linked, False)
    component = np.arange(len(rows))
    while True:
        least = np.minimum(component, np.where(linked, component[None, :], len(rows)).min(axis=1))
        if (least == component).all():
            break
        component = least
    got = {r.vec_id: r for r in sorted_passes.near_vectors(frame, scratch).collect()}
    assert [got[k].n_links for k in range(len(rows))] == linked.sum(axis=1).tolist()
    assert [got[k].component_id for k in range(len(rows))] == component.tolist()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


ODD = [
    (1, None, 0, 1, "x"), (2, [], 0, 1, "x"), (3, [0.0, 0.0], 0, 1, "x"), (4, [1.0, None], 0, 1, "x"), (5, [float("nan"), 1.0], 0, 1, "x"),
    (6, [float("inf"), 1.0], 0, 1, "x"), (7, [1.0, 0.0], None, 1, "x"), (8, [1.0, 0.0], 0, 1, "x"), (9, [2.0, 0.0], 0, 1, "x"),
    (10, [1.0, 0.0], 1, 1, "x"), (11, [1.0, 0.0, 0.0], 0, 1, "x"), (12, [-1.0, 0.0], 0, 1, "x"), (None, [1.0, 0.0], 0, 1, "x"),
    (8, [1.0, 0.0], 0, 1, "x"),
]


def test_odd_vectors_link_with_nothing(make, scratch):
    got = sorted_passes.near_vectors(make(ODD, SCHEMA), scratch).collect()
    assert len(got) == len(ODD)
    links = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None)
    assert links == sorted([(k, 0, k, True) for k in (1, 2, 3, 4, 5, 6, 7, 10, 11, 12)] + [(8, 2, 8, True)] * 2 + [(9, 2, 8, False)])
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert sorted_passes.near_vectors(make([], SCHEMA), scratch).count() == 0


def nearest_by_hand(rows, k=5):
    scores = cosines(rows.astype(float))
    np.fill_diagonal(scores, -np.inf)
    return scores


@pytest.mark.parametrize("shard_rows", [100, 8192])
def test_exact_at_factor_one(make, scratch, corpus, shard_rows):
    rows, labels = corpus
    frame = make([(k, [float(x) for x in r], 0, 1, "x") for k, r in enumerate(rows)], SCHEMA)
    got = {}
    for r in vp_search.nearest(frame, F.col("vec_id") % 10 == 0, scratch, shard_rows=shard_rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    scores = nearest_by_hand(rows)
    assert set(got) == set(range(0, len(rows), 10))
    for query, found in got.items():
        found.sort()
        best = np.sort(scores[query])[::-1][:5]
        assert [s for _, _, s in found] == pytest.approx(best.tolist(), abs=1e-12)
        assert [x[0] for x in found] == [1, 2, 3, 4, 5]
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))


def test_recall_when_relaxed(make, scratch):
    draw = np.random.default_rng(2)
    rows = draw.standard_normal((3000, 8)).astype(np.float32)
    frame = make([(k, [float(x) for x in r], 0, 1, "x") for k, r in enumerate(rows)], SCHEMA)
    exact, loose = ({(r.query_id, r.vec_id) for r in vp_search.nearest(frame, F.col("vec_id") % 50 == 0, scratch, factor=f).collect()}
                    for f in (1.0, 0.7))
    assert len(exact & loose) >= 0.9 * len(exact)


def test_copies_tie_by_number(make, scratch):
    rows = [(k, [1.0, 2.0, 3.0], 0, 1, "x") for k in range(400, 0, -1)] + [(0, [1.0, 2.0, 3.0], 0, 1, "x")]
    got = vp_search.nearest(make(rows, SCHEMA), F.col("vec_id") == 0, scratch, shard_rows=50).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(k, k) for k in range(1, 6)]


def test_odd_vectors_take_no_part(make, scratch):
    got = vp_search.nearest(make(ODD, SCHEMA), F.col("vec_id") == 8, scratch).collect()
    by = sorted((r["rank"], r.vec_id) for r in got)
    # Two rows ask; each finds the other one first, then the rest by number, the one without a number last.
    assert by == sorted([(1, 7), (2, 8), (3, 9), (4, 10), (5, None)] * 2, key=lambda x: (x[0], x[1] or 0))
    assert vp_search.nearest(make([], SCHEMA), F.col("vec_id") == 8, scratch).count() == 0


def test_copies_of_blocks_do_not_pass_the_driver(make, scratch):
    draw = np.random.default_rng(3)
    rows = [(k, [float(x) for x in r], 0, 1, "x") for k, r in enumerate(draw.standard_normal((200, 4)))]
    found = vp_search.nearest(make(rows, SCHEMA), F.col("vec_id") % 2 == 0, scratch, shard_rows=20)
    assert len(found.collect()) == 500
    # The tables are far below the size up to which Spark broadcasts on its own.
    assert "Broadcast" not in checks.plan(found)
