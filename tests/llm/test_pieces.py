import random

import pyarrow as pa
import pytest
import sentencepiece

from stormglass.llm import pieces

TEXTS = [
    "", None, " ", "   ", "a", "\n", "a\n\nb", "  a  b ", "Hello\tworld\n x", "ﬁ½ Ａ", "a▁b", "日本語 🤗 x", "aaaaaaa" * 15, "zz" * 100,
    "\0a\0", "the" * 300, "x" * 3000, " " * 100, "a" + " " * 37 + "b", "the and the and", "\r\n\x85 x", "A" * 5 + "é" * 9,
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_pieces_are_those_of_the_library(vocabulary, model):
    draw = random.Random(5)
    texts = TEXTS + ["".join(draw.choice("abetionsrh  \n.,é🤗日AB1") for _ in range(draw.randint(1, 90))) for _ in range(1500)]
    encoded = pieces.encode_batch(pa.array(texts, pa.string()), vocabulary)
    expected = model.encode([t or "" for t in texts])
    assert encoded.to_pylist() == expected
    assert pieces.decode_batch(encoded, vocabulary).to_pylist() == model.decode(expected)


def test_decoding_any_lists(vocabulary, model):
    lists = [[], None, [259 + 1, 300], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [1, 300, 2]]
    decoded = pieces.decode_batch(pa.array(lists, pa.list_(pa.int32())), vocabulary).to_pylist()
    assert decoded[0] == "" and decoded[1] is None and decoded[3] == "�" and decoded[4] == "é"
    assert decoded[2] == model.decode([260, 300])


def test_suffix_ranges_find_every_occurrence(vocabulary):
    import numpy as np

    text = "thetheandthe the"
    numbers = {chr(p): k + 1 for k, p in enumerate(vocabulary.alphabet)}
    chars = np.array([numbers[c.replace(" ", "▁")] for c in text])
    end, piece = pieces.edges(chars, vocabulary)
    found = {(int(e), vocabulary.pieces[p].decode()) for e, p in zip(end, piece, strict=True)}
    known = {p.decode() for k, p in enumerate(vocabulary.pieces) if vocabulary.lengths[k]}
    assert found == {(b, text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if text[a:b] in known}


def test_frames(documents, vocabulary, model):
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)] + [(1, None, None), (None, "x", "s"), (None, "x", "s")]
    frame = documents(rows).withColumnRenamed("component", "pieces")
    encoded = pieces.encode(frame, vocabulary)
    assert encoded.columns == ["doc_id", "text", "source", "a", "pieces"]
    assert [r.pieces for r in encoded.collect()] == model.encode([t or "" for _, t, _ in rows])
    checked = pieces.decode_digest(encoded, vocabulary).collect()
    assert all(r.round_trip for r in checked if "▁" not in (TEXTS[r.doc_id] or "" if r.doc_id is not None else ""))
    assert len(checked) == len(rows)
    assert pieces.decode_digest(pieces.encode(documents([]), vocabulary), vocabulary).count() == 0
