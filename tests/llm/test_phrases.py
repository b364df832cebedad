"""Phrases against a plain count with exact arithmetic."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stormglass.llm import phrases

SCHEMA = "doc_id bigint, lang string, text string, w1 int, n string, word int"


def plain(rows, least, top):
    found, sizes = {}, Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        counts = found.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            sizes[lang or "und"] += len(words)
            for k in range(1, 6):
                counts.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in found.items():
        kept = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            longer = (q for q, b in f.items() if len(q) > len(p) and b >= least and 100 * b >= 100 * a)
            if any(q[i:i + len(p)] == p for q in longer for i in range(len(q) - len(p) + 1)):
                continue
            score, _, l, r = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def found(make, scratch, rows, **more):
    docs = make([(k, *r, 1, "n", 2) for k, r in enumerate(rows)], SCHEMA)
    result = phrases.collocations(docs, scratch, **more)
    return sorted(tuple(r) for r in result.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("budget, least", [(3, 2), (25, 4), (1_000_000, 3)])
def test_random_texts(make, scratch, budget, least, monkeypatch):
    monkeypatch.setattr(phrases, "_HELD_WINDOWS", 40)
    monkeypatch.setattr(phrases, "FEW_WORDS", 0 if budget == 3 else 1000)
    monkeypatch.setattr(phrases, "_HELD_HASHES", 50)
    pick = random.Random(budget)
    words = ["A", "b", "B", "c", "é", "dd", "日本"]
    text = lambda: "".join(pick.choice(words) + pick.choice([" ", "\t", "  ", " ", " ", ". ", ",", "\n"]) for _ in range(pick.randint(0, 40)))
    rows = [(pick.choice(["en", "en", "fr", None, "und"]), text()) for _ in range(60)]
    expected = plain(rows, least, 12)
    assert found(make, scratch, rows, least=least, top=12, budget=budget) == expected
    assert len(expected) > 12


def test_odd_texts(make, scratch):
    same = ("en", "one two three. one two three")
    rows = [same, same, same, ("en", None), ("en", ""), (None, None), ("fr", " \t "), ("fr", "!?"), ("de", "x " * 20_000),
            ("es", "a" * 100_000 + " b c " * 3), (None, "one two one two"), ("en", "ONE TWO\x0bTHREE one\x0ctwo"), ("en", "é É É é é É")]
    assert found(make, scratch, rows, least=2, top=2000) == plain(rows, 2, 2000)
    assert found(make, scratch, rows, least=1, top=5) == plain(rows, 1, 5)


def test_empty_table(make, scratch):
    assert found(make, scratch, [], least=1) == []


def test_products_of_more_than_64_bits(spark, make):
    big = 4_000_000_000_000
    counts = make([([1], big), ([2], big - 1), ([1, 2], big - 3)], "phrase array<bigint>, f bigint")
    counts = counts.withColumn("lang", F.lit("en"))
    sizes = make([("en", 900_000_000_000_000)], "lang string, size bigint")
    row = phrases.scored(counts, sizes).select(F.col("score")).first()
    assert row["score"] == 1000 * (big - 3) * 900_000_000_000_000 // (big * (big - 1))
