import random

import pytest
from pyspark.sql import functions as F

from stormglass.llm import mixing


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        open_ = [s for s in order if s not in capped]
        target = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if target[s] > most * sizes[s] + 1e-9]
        if not over:
            return capped | target
        capped |= {s: most * sizes[s] for s in over}


def mixed(frame, scratch, **options):
    rows = frame.withColumns({"size": mixing.word_count(F.col("text")), "weight": F.coalesce("w", F.lit(1.0)),
                              "u": mixing.uniform(5, "doc_id", "text")})
    return mixing.pareto_mix(rows, scratch, **options).collect()


SCHEMA = "doc_id bigint, text string, source string, w double, target string, rate int"


def corpus(n, hot=0.34):
    random.seed(3)
    rows = []
    for k in range(n):
        source = None if k % 29 == 0 else "hot" if random.random() < hot else random.choice(["a", "b", "Ä", "z"])
        rows.append((k, "w " * random.choice([0, 1, 5, 20, 40]), source, None, "x", 1))
    return rows + [(n, None, "a", None, "x", 1), (n + 1, "x " * 3000, "hot", None, "x", 1), (None, "a b", "b", None, "x", 1)]


def test_targets_and_taken_words(make, scratch):
    rows = corpus(3000)
    got = mixed(make(rows, SCHEMA), scratch)
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    expected = filled(sizes)
    for source, target in expected.items():
        mine = [r for r in got if r.source == source]
        assert mine[0].source_size == sizes[source]
        assert mine[0].target == pytest.approx(target)
        assert abs(sum(r.copies * r.size for r in mine) - target) <= 41
    assert {r.copies for r in got} <= {0, 1, 2}


def test_reruns_agree(make, scratch):
    frame = make(corpus(500), SCHEMA)
    first, second = ({(r.doc_id, r.text): r.copies for r in mixed(f, scratch)} for f in (frame, frame.repartition(7)))
    assert first == second


def test_weights_make_odds_unequal(make, scratch):
    rows = [(k, "w " * 10, "a", 3.0 if k % 2 else 0.5, "x", 1) for k in range(4000)]
    got = mixed(make(rows, SCHEMA), scratch, share=0.5)
    heavy, light = (sum(r.copies for r in got if (r.doc_id % 2 == 1) == odd) for odd in (True, False))
    assert heavy / light == pytest.approx(6, rel=0.15)
    assert abs(10 * (heavy + light) - 20000) <= 10


def test_heavy_documents_stop_at_the_most_copies(make, scratch):
    rows = [(k, "w " * 10, "a", 100.0 if k < 10 else 1.0, "x", 1) for k in range(100)]
    got = mixed(make(rows, SCHEMA), scratch)
    assert all(r.copies == 2 for r in got if r.doc_id < 10)
    assert abs(sum(r.copies for r in got) - 150) <= 1


def test_pareto_sampling_keeps_inclusion_odds(make, scratch):
    """Over many sources, documents are taken as often as their inclusion says."""
    rows = [(100 * s + k, "w", f"s{s:02d}", 1.0 if k < 5 else 2.0, "x", 1) for s in range(60) for k in range(10)]
    got = mixed(make(rows, SCHEMA), scratch, share=0.6, weights=(1,))
    light, heavy = (sum(r.copies for r in got if (r.doc_id % 100 < 5) == low) for low in (True, False))
    assert light + heavy == 60 * 6
    assert light / 300 == pytest.approx(0.4, abs=0.08)
    assert heavy / 300 == pytest.approx(0.8, abs=0.08)


def test_many_equal_rows_share_a_rank(make, scratch, spark):
    same = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"),
                                    F.lit(None).cast("double").alias("w"), F.lit("x").alias("target"), F.lit(1).alias("rate"))
    other = make([(k, "w " * 3000, "t", None, "x", 1) for k in range(2, 4)], SCHEMA)
    got = mixed(same.unionByName(other), scratch, weights=(1, 1, 1), share=1.1)
    mine = [r for r in got if r.source == "s"]
    assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= 2


def test_empty_and_wordless(make, scratch):
    assert mixed(make([], SCHEMA), scratch) == []
    got = mixed(make([(1, None, "a", None, "x", 1), (2, " \n", None, None, "x", 1)], SCHEMA), scratch)
    assert {(r.size, r.target, r.copies * r.size) for r in got} == {(0, 0.0, 0)}


def test_word_count_parts_at_ascii_space_only(make):
    frame = make([("a\tb\x0bc d  e\x1cf",)], "text string")
    assert frame.select(mixing.word_count(F.col("text"))).first()[0] == 4


def test_rank_and_cut_are_those_of_a_plain_sort(make, scratch):
    """Unequal odds: expected copies by weight, certain copies, then the smallest odds ratios up to the words that come nearest."""
    import random

    pick = random.Random(8)
    rows = [(k, pick.choice(["a", "b", None]), pick.randint(1, 400), pick.random()) for k in range(300)]
    frame = make(rows, "doc_id bigint, source string, size bigint, u double").withColumn("weight", mixing.length_weight(F.col("size")))
    found = {r["doc_id"]: r for r in mixing.pareto_mix(frame, scratch, tolerance=0.0).collect()}
    for source in ("a", "b", None):
        docs = [(k, n, n ** 0.5, u) for k, s, n, u in rows if s == source]
        target = found[docs[0][0]]["target"]
        stopped = set()
        while True:
            left = target - sum(2 * n for k, n, _, _ in docs if k in stopped)
            if len(stopped) == len(docs):
                break
            rate = max(0.0, left) / sum(n * w for k, n, w, _ in docs if k not in stopped)
            more = {k for k, _, w, _ in docs if w * rate >= 2} - stopped
            if not more:
                break
            stopped |= more
        copies, ranked = {}, []
        for k, n, w, u in docs:
            expected = 2.0 if k in stopped else min(2.0, w * rate)
            copies[k] = int(expected)
            if expected > int(expected):
                part = expected - int(expected)
                odds = u / (1 - u) / (part / (1 - part))
                ranked.append((odds / (1 + odds), k, n))
        left, taken = target - sum(copies[k] * n for k, n, _, _ in docs), 0
        for _, k, n in sorted(ranked):
            if taken + n - n / 2 > left:
                break
            taken += n
            copies[k] += 1
        assert {k: found[k]["copies"] for k in copies} == copies


def test_sources_that_stop_in_different_rounds(make, scratch):
    """A source that is taken whole at once stays so while others still share anew; it has documents without words."""
    rows = [(k, "a", 1 + (k * k) % 900, k) for k in range(60)] + [(100 + k, "b", 3 ** (k % 8), k) for k in range(60)]
    rows += [(200 + k, "c", 10 * (k % 2), k) for k in range(5)]
    frame = make(rows, "doc_id bigint, source string, size bigint, k int").withColumn(
        "weight", F.col("size").cast("double") + 0.1).withColumn("u", (F.col("k") % 59 + 1) / 61)
    found = mixing.pareto_mix(frame, scratch).collect()
    assert len(found) == 125 and all(0 <= r["copies"] <= 2 for r in found)
    for source in "abc":
        docs = [r for r in found if r["source"] == source]
        assert abs(sum(r["copies"] * r["size"] for r in docs) - docs[0]["target"]) <= max(r["size"] for r in docs)
