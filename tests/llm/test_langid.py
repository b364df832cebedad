import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormglass.llm import langid, pieces

DATA = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


def sum_of_segmentations(text, known):
    """By trying all cuts."""
    if not text:
        return 1.0
    return sum(p * sum_of_segmentations(text[len(t):], known) for t, p in known.items() if text.startswith(t))


def test_forward_sums_all_segmentations(vocabulary):
    draw = np.random.default_rng(1)
    probability = np.append(np.where(vocabulary.lengths[:-1] > 0, draw.random(len(vocabulary.lengths) - 1), 0), 0.1)
    words = [" then", " a", "thethe", "x\U0001f917y", " "]
    known = {p.decode().replace(" ", "▁"): probability[k] for k, p in enumerate(vocabulary.pieces) if vocabulary.lengths[k]}
    known["\U0001f917"] = 0.1
    got = langid.Lattice(words, vocabulary).log_likelihood(probability[:, None])[:, 0]
    for word, value in zip(words, got, strict=True):
        assert value == pytest.approx(math.log(sum_of_segmentations(word.replace(" ", "▁"), known)))


def test_long_words_do_not_vanish(vocabulary):
    probability = langid._probabilities(np.ones(len(vocabulary.pieces)), vocabulary)
    one, many = langid.Lattice([" " + "ab" * 50, " " + "ab" * 5000], vocabulary).log_likelihood(probability[:, None])[:, 0]
    assert np.isfinite(many) and many < 50 * one


def test_held_out_accuracy(spark, scratch):
    docs = spark.read.parquet(DATA)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    found = langid.identify(docs, docs.where(~held), scratch).where(held)
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_odd_rows(documents, make, scratch):
    labelled = make([("the and of with", "en"), ("der die und nicht", "de"), ("le la les une", "fr"), (None, "xx"), ("abc", None)],
                    "text string, lang string")
    rows = [(1, None, "s"), (2, "", "s"), (3, "123 !?", "s"), (4, "the and of", "s"), (4, "the and of", "s"), (None, "DER UND", None),
            (5, "the " * 60000, "s"), (6, "日本", "s")]
    frame = documents(rows).withColumnRenamed("component", "lang_pred")
    got = langid.identify(frame, labelled, scratch).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "source", "a", "lang_pred", "score"}
    assert [(by[k].lang_pred, by[k].score) for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by[4].lang_pred == by[5].lang_pred == "en" and by[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got) and by[6].lang_pred in ("de", "en", "fr")


def test_empty_tables(documents, make, scratch):
    none = make([], "text string, lang string")
    assert langid.identify(documents([]), none, scratch).count() == 0
    assert langid.identify(documents([(1, "the", "s")]), none, scratch).first().lang_pred == "und"


def test_languages_without_spaces_are_learned(make, scratch):
    """Texts of one long chunk: Han and kana each get a model, and held-out ones are told apart."""
    import random

    pick = random.Random(2)
    han, kana = [chr(0x4E00 + 7 * k) for k in range(300)], [chr(0x3041 + k) for k in range(80)]
    english = "the of and to in is that for it was on are with they be at one have this from".split()
    make_text = {"en": lambda: " ".join(pick.choices(english, k=60)), "zh": lambda: "".join(pick.choices(han, k=200)),
                 "ja": lambda: "".join(pick.choices(kana, k=150) + pick.choices(han, k=20))}
    labelled = make([(make_text[x](), x) for x in make_text for _ in range(60)], "text string, lang string")
    held_out = make([(k, make_text[x](), x) for k, x in enumerate(list(make_text) * 15)], "doc_id bigint, text string, expected string")
    found = langid.identify(held_out, labelled, scratch).collect()
    assert all(r["lang_pred"] == r["expected"] for r in found)


def test_expected_uses_are_those_of_all_segmentations(vocabulary):
    words = ["the", "inter"]
    lattice = langid.Lattice(words, vocabulary)
    weights = (np.arange(len(lattice.piece)) % 7 + 1) / 10
    uses = lattice.expected(weights, np.array([2.0, 3.0]))
    ends = {}
    for e in range(len(lattice.piece)):
        ends.setdefault(int(lattice.begin[e]), []).append(e)

    def ways(at, stop):
        if at == stop:
            yield []
        for e in ends.get(at, []):
            if lattice.end[e] <= stop:
                for rest in ways(int(lattice.end[e]), stop):
                    yield [e, *rest]

    plain = np.zeros(len(uses))
    for k, word in enumerate(words):
        found = list(ways(int(lattice.starts[k]), int(lattice.starts[k] + lattice.lengths[k])))
        chances = np.array([np.prod(weights[w]) for w in found])
        for w, chance in zip(found, chances / chances.sum()):
            plain[w] += chance * [2.0, 3.0][k]
    assert np.allclose(uses, plain)
