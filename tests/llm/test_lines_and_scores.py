import itertools
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stormglass.llm import fuzzy_lines, suffix_tree_lm


def shingles(line):
    return {line[k:k + 5] for k in range(max(1, len(line) - 4))}


def line(draw, n):
    return " ".join("".join(draw.choice("aeiourstlnm") for _ in range(draw.randint(2, 9))) for _ in range(n))


def test_lines_by_brute_force(documents, scratch):
    draw = random.Random(3)
    base = [line(draw, n) for n in (3, 6, 9, 12, 14, 20, 40, 120) for _ in range(5)]
    rows = []
    for k in range(60):
        lines = [line(draw, draw.randint(2, 60)) for _ in range(3)]
        for text in draw.sample(base, 4):
            at = draw.randrange(len(text))
            lines.append(text[:at] + draw.choice(["", "x", "zz"]) + text[at + 1:])
        draw.shuffle(lines)
        rows.append((k, "\n".join(lines), "s"))
    every = [(k, p, x) for k, t, _ in rows for p, x in enumerate(t.split("\n"))]
    sets = [shingles(x) for _, _, x in every]
    parent = list(range(len(every)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for a, b in itertools.combinations(range(len(every)), 2):
        common = len(sets[a] & sets[b])
        if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
            links += 1
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    expected = {every[k][:2] for k in range(len(every)) if root(k) == k}
    left = fuzzy_lines.drop_repeated_lines(documents(rows), scratch).collect()
    got = set()
    for r in left:
        kept = Counter(r.text.split("\n") if r.text else [])
        assert r.n_lines - r.n_gone == sum(kept.values())
        got |= {(r.doc_id, p) for p, x in enumerate(rows[r.doc_id][1].split("\n")) if kept[x]}
    assert links > 300
    assert len(got ^ expected) <= 2


def test_common_words_are_searched_by_two_bands(documents, scratch, monkeypatch):
    """Lines of common long words only share large buckets, but few of them share two."""
    draw = random.Random(4)
    pool = ["".join(draw.choice("abcdefghijklmnop") for _ in range(20)) for _ in range(60)]
    rows = [" ".join(draw.sample(pool, 12)) for _ in range(250)]
    copies = draw.sample(range(250), 50)
    rows += [rows[k][:130] + "zz" + rows[k][130:] for k in copies]
    searched, compared = [], []
    search, compare = fuzzy_lines._sharing_rare, fuzzy_lines.with_similarity
    monkeypatch.setattr(fuzzy_lines, "_sharing_rare", lambda lines, *a: (searched.append(lines.count()), search(lines, *a))[1])
    monkeypatch.setattr(fuzzy_lines, "with_similarity", lambda pairs: (compared.append(pairs.count()), compare(pairs))[1])
    left = fuzzy_lines.drop_repeated_lines(documents([(k, x, "s") for k, x in enumerate(rows)]), scratch).collect()
    assert {r.doc_id for r in left if r.n_gone} == set(range(250, 300))
    assert sum(searched) < 100
    assert sum(compared) < 2 * len(copies)


def test_rare_shingles_leave_out_what_cannot_be_similar(make, scratch):
    draw = random.Random(8)
    pool = [line(draw, 4) for _ in range(60)]
    rows = []
    for n in (4, 5, 6, 60, 80):  # short lines go by their sketches, long ones by the shingles they share
        for _ in range(60):
            text = " ".join(draw.choice(pool) if draw.random() < 0.4 else line(draw, 4) for _ in range(n))
            at = draw.randrange(len(text))
            rows += [text] if draw.random() < 0.8 else [text, text[:at] + draw.choice(["", "x", "zz"]) + text[at + 3:]]
    rows += [rows[0][:k] + "same end of all lines" for k in range(20, 60)]
    sets, similar = [shingles(x) for x in rows], set()
    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) and a // 2 != b // 2:
            similar.add((a, b))
    lines = make([(k, k // 2, x) for k, x in enumerate(rows)], "number bigint, component bigint, line string")
    found = {(r.a, r.b) for r in fuzzy_lines._sharing_rare(lines, 0.8, scratch).collect()}
    assert len(similar) > 100
    assert similar <= found
    assert len(found) < 2 * len(similar)


def test_sketches_tell_long_lines_apart(make, scratch):
    draw = random.Random(8)
    pool = [line(draw, 30) for _ in range(4)]
    rows = []
    for _ in range(60):  # of about 350 shingles, half of them from one of a few passages
        text = draw.choice(pool) + " " + line(draw, 30)
        at = draw.randrange(len(text))
        rows += [text, text[:at] + "zz" + text[at + 3:]]
    sets = [shingles(x) for x in rows]
    similar = {(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
               if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(similar) == 60 and all(a // 2 == b // 2 for a, b in similar)
    lines = make([(k, k, x) for k, x in enumerate(rows)], "number bigint, component bigint, line string")
    own = fuzzy_lines.rare_shingles(lines, 0.8).select("number", "size", *fuzzy_lines._SKETCH).distinct().cache()
    other = own.select(*(F.col(x).alias(f"{x}_of") for x in own.columns))
    may_be = fuzzy_lines._may_be_similar(F.col("size") + F.col("size_of"), 0.8)
    pairs = own.join(other, F.col("number") < F.col("number_of")).where(may_be).select("number", "number_of")
    found = {tuple(r) for r in pairs.collect()}
    assert similar <= found
    assert len(found) < 2 * len(similar)


def test_rare_shingles_in_parts(make, scratch, monkeypatch):
    draw = random.Random(9)
    rows = [line(draw, draw.randint(6, 40)) for _ in range(80)]
    rows += [x[:-3] + "zz" for x in rows] + [x[:len(x) // 2] + line(draw, 8) for x in rows]
    lines = make([(k, k, x) for k, x in enumerate(rows)], "number bigint, component bigint, line string").cache()
    joined, stage = [], scratch.stage

    def counted(df, label):
        out = stage(df, label)
        if label == "rare":
            joined.append(out.count())
        return out

    monkeypatch.setattr(scratch, "stage", counted)
    whole = sorted(fuzzy_lines._sharing_rare(lines, 0.8, scratch).collect())
    monkeypatch.setattr(fuzzy_lines, "PART_TOKENS", 1)
    parts = sorted(fuzzy_lines._sharing_rare(lines, 0.8, scratch).collect())
    assert len(whole) >= 80 and parts == whole
    assert len(joined) == 1 + fuzzy_lines.PARTS and sum(joined[1:]) == joined[0] and max(joined[1:]) < joined[0] / 2


def test_lines_of_a_long_template(documents, scratch):
    draw = random.Random(8)
    template, rows = line(draw, 60)[:200], []
    for _ in range(60):
        own = line(draw, 30)[:60]
        for _ in range(2):
            at = draw.randrange(60)
            rows.append((len(rows), template + " " + own[:at] + draw.choice("XYZ") + own[at + 1:], "s"))
    sets = [shingles(x) for _, x, _ in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        assert (common >= 0.8 * (len(sets[a]) + len(sets[b]) - common)) == (b == a + 1 and a % 2 == 0)
    left = fuzzy_lines.drop_repeated_lines(documents(rows), scratch).collect()
    assert {r.doc_id for r in left if r.n_gone} == set(range(1, len(rows), 2))


HAN = "".join(chr(0x4E00 + 37 * k * k % 5000) for k in range(400))


def test_odd_lines(documents, scratch):
    rows = [(2, "same line here\nonly in two\n\n  \nsame line here", "s"), (1, "same line here\r\nother", "s"), (3, None, "s"), (4, "", "s"),
            (None, "only in two", "s"), (5, HAN, "s"), (6, HAN[:-1] + "x", "s"), (7, "a" * 70000, "s"), (8, "ab", "s"), (9, "ab", "s"),
            (10, "\n\n", "s"), (11, "a b", "s"), (11, "a b", "s")]
    frame = documents(rows).withColumnRenamed("component", "places")
    got = {}
    for r in fuzzy_lines.drop_repeated_lines(frame, scratch).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_gone))
    assert got[1] == [("same line here\r\nother", 2, 0)]
    assert got[2] == [("only in two\n\n  ", 3, 2)]
    assert got[3] == [(None, 0, 0)] and got[4] == [("", 0, 0)] and got[10] == [("\n\n", 0, 0)]
    assert got[None] == [("", 1, 1)] and got[6] == [("", 1, 1)] and got[9] == [("", 1, 1)] and got[8] == [("ab", 1, 0)]
    assert got[7] == [("a" * 70000, 1, 0)] and got[11] == [("a b", 1, 0)] * 2
    assert fuzzy_lines.drop_repeated_lines(documents([]), scratch).count() == 0


def test_native_plan(documents, scratch):
    frame = fuzzy_lines.drop_repeated_lines(documents([(1, "a\nb", "s")]), scratch)
    assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().executedPlan().toString())


def normal(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_keys_are_the_bytes_after_their_contexts():
    texts = ["  Ab  c\n", "", None, "é", "\t\n", "x"]
    keys, begins = suffix_tree_lm.keys_of(suffix_tree_lm.lowered(pa.array(texts, pa.string())))
    for k, text in enumerate(texts):
        stream = b"\n" * 5 + " ".join(normal(text)).encode() + b"\n"
        mine = [int(x).to_bytes(6, "big") for x in keys[begins[k]:begins[k + 1]]]
        assert mine == [stream[p - 5:p][::-1] + stream[p:p + 1] for p in range(5, len(stream))]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(8)
    common = ["the", "of", "and", "to"]
    rows = [" ".join(draw.choice(common) if draw.random() < 0.5 else line(draw, 1) for _ in range(80)) for _ in range(150)]
    return rows + [None, "", " \n ", "É́ ŸX Z", "word " * 20000, rows[0], rows[0]]


def score(documents, scratch, texts):
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    frame = documents(rows).withColumnRenamed("component", "score")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return {r.doc_id: r for r in suffix_tree_lm.score_texts(frame, ~held, scratch).collect()}


def test_base_scores_by_hand(documents, scratch, texts):
    got = score(documents, scratch, texts)
    tokens = [normal(t) + [None] for t in texts]
    held = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    count = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    total, kinds = sum(count.values()), len(count)
    for k, ts in enumerate(tokens):
        base = sum(math.log10((count[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in ts)
        assert got[k].base_score == pytest.approx(base, abs=1e-6)
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(ts), sum(count[t] > 0 for t in ts), total)
        assert got[k].score < 0


def test_tree_probabilities_by_hand(spark, make, scratch, texts):
    """Probabilities over all next bytes sum to 1 in every state, and follow the recursive definition."""
    frame = make([(t,) for t in texts], "text string")
    counts = scratch.stage(suffix_tree_lm.count_symbols(frame), "counts")
    tree = suffix_tree_lm.grow(counts)
    assert sum(map(len, tree.contexts)) > 20
    import numpy as np

    for context in (b"\n\n\n\n\n", b"eht t", b" dna ", b"zzzzz", b"ht of"):
        keys = (int.from_bytes(context, "big") << 8) | np.arange(256)
        assert (10 ** tree.log10(keys)).sum() == pytest.approx(1.0, abs=1e-9)
    for length, contexts in enumerate(tree.contexts[1:], 2):  # suffixes of held contexts are held
        assert np.isin(contexts >> 8, tree.contexts[length - 2]).all()


def test_contexts_help_and_repeats_score_alike(documents, make, scratch, texts):
    got = score(documents, scratch, texts)
    assert got[0].score == got[len(texts) - 1].score == got[len(texts) - 2].score
    held = [texts[k] for k in range(150) if zlib.crc32(str(k).encode()) % 5 == 1]
    counts = scratch.stage(suffix_tree_lm.count_symbols(make([(t,) for t in texts if t not in held], "text string")), "counts")
    keys = suffix_tree_lm.keys_of(suffix_tree_lm.lowered(pa.array(held)))[0]
    tree, root = (suffix_tree_lm.grow(counts, divergence=d) for d in (suffix_tree_lm.DIVERGENCE, 99.0))
    assert sum(map(len, root.contexts)) == 0
    assert tree.log10(keys).sum() > 0.75 * root.log10(keys).sum()


def test_nothing_to_learn_from(documents, scratch):
    rows = documents([(1, "a b", "s"), (2, None, "s")])
    got = {r.doc_id: r for r in suffix_tree_lm.score_texts(rows, F.lit(False), scratch).collect()}
    assert got[1].train_tokens == 0 and got[1].n_known == 0 and got[1].base_score == pytest.approx(0.0)
    assert got[1].score == pytest.approx(4 * math.log10(1 / 256))
    assert suffix_tree_lm.score_texts(documents([]), F.lit(True), scratch).count() == 0
