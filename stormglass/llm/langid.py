"""Language identification by unigram piece models, summed over all segmentations of a text.

Each language has a probability for every piece of one fixed vocabulary. A word can be cut into
pieces in many ways; its probability is the sum over all of them, which a forward pass over the lattice of
piece occurrences gives. The probabilities are fitted by expectation maximisation on word counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormglass.llm.chunks import give_back, slices, split_chunks
from stormglass.llm.pieces import MODEL, Vocabulary, alone, edges, load_vocabulary
from stormglass.llm.scratch import Scratch

#: Labelled documents per language that the piece probabilities are fitted on, at most (the documented bound
#: of the classifier's sample), and rounds of fitting.
SAMPLE_DOCS, ROUNDS = 2000, 3
#: Added to each expected count; probability of a character that no piece holds.
_PRIOR, _STRANGE = 0.02, 1e-6
_SLICE_BYTES, _LATTICE_CHARS = 4_000_000, 150_000
#: Fitting cuts longer words into parts of so many characters, since its sums are not scaled; scoring takes words whole.
_FIT_CHARS = 64
_HAS_LETTER = r"\p{L}"
UNKNOWN = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    probability: np.ndarray  # piece x language, one more row for unknown characters


class Lattice:
    """Piece occurrences in some words, by the place in the word where they end."""

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        joined = "\0".join(words) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        points = np.where(points == 0x20, 0x2581, points)
        numbers = np.full(0x110000, len(vocabulary.alphabet) + 1, np.uint16)
        numbers[vocabulary.alphabet] = np.arange(len(vocabulary.alphabet)) + 1
        chars = numbers[points].astype(np.int64)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]]).astype(np.int64)
        chars[self.starts + self.lengths] = 0
        end, piece = edges(chars, vocabulary)
        word = np.repeat(np.arange(len(words)), self.lengths + 1)[end - 1]
        step = end - self.starts[word]
        order = np.argsort(step * (len(chars) + 1) + end, kind="stable")
        self.word, self.end, self.piece = word[order], end[order], piece[order]
        self.begin = self.end - vocabulary.lengths[self.piece]
        self.rounds = np.searchsorted(step[order], np.arange(1, int(self.lengths.max(initial=0)) + 2))
        self.reach = int(vocabulary.lengths.max())

    def forward(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all segmentations up to each position, and each word's log scale.

        weights: a row per edge, a column per model. Every ``reach`` rounds the positions still in use are scaled
        to a largest value of 1, so that long words do not vanish.
        """
        models = weights.shape[1]
        total = np.zeros((int((self.lengths + 1).sum()) + 1, models))
        total[self.starts] = 1.0
        scale = np.zeros((len(self.lengths), models))
        for offset, (a, b) in enumerate(zip(self.rounds[:-1], self.rounds[1:], strict=True), 1):
            if a == b:
                continue
            end = self.end[a:b]
            first = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
            total[end[first]] = np.add.reduceat(total[self.begin[a:b]] * weights[a:b], first, axis=0)
            if offset % self.reach == 0:
                words = np.flatnonzero(self.lengths >= offset)
                at = (self.starts[words] + offset)[:, None] - np.arange(self.reach)
                most = total[at].max(axis=1)
                most[most == 0] = 1.0
                total[at] /= most[:, None, :]
                scale[words] += np.log(most)
        return total, scale

    def log_likelihood(self, probability: np.ndarray) -> np.ndarray:
        """Log probability of every word under every model."""
        total, scale = self.forward(probability[self.piece])
        with np.errstate(divide="ignore"):
            return np.maximum(np.log(total[self.starts + self.lengths]), -1e6) + scale

    def expected(self, weights: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every edge, words weighted by their counts (words short enough not to be scaled)."""
        total = self.forward(weights[:, None])[0][:, 0]
        rest = np.zeros(len(total))
        rest[self.starts + self.lengths] = 1.0
        for a, b in reversed(list(zip(self.rounds[:-1], self.rounds[1:], strict=True))):
            np.add.at(rest, self.begin[a:b], rest[self.end[a:b]] * weights[a:b])
        whole = total[self.starts + self.lengths][self.word]
        return total[self.begin] * weights * rest[self.end] / np.maximum(whole, 1e-300) * counts[self.word]


def _blocks(words: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of words of about _LATTICE_CHARS characters."""
    sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    done = 0
    while done < len(words):
        upto = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + _LATTICE_CHARS)))
        yield done, upto
        done = upto


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))


def _cut(words: list[str], counts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Long words in parts of _FIT_CHARS characters, each as frequent as its word."""
    parts = [[w[k:k + _FIT_CHARS] for k in range(0, len(w), _FIT_CHARS)] for w in words]
    return [x for found in parts for x in found], np.repeat(counts, [len(x) for x in parts]).astype(np.int64)


def _word_counts(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(lang, word, n) of labelled texts."""
    marks = alone(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                for lang in pc.unique(part.column("lang")).to_pylist():
                    texts = part.column("text").filter(pc.equal(part.column("lang"), lang))
                    words, codes, _ = split_chunks(_lowered(texts), marks, any_space=True)
                    counts = np.bincount(codes, minlength=len(words))
                    short = pc.less_equal(pc.utf8_length(words), _FIT_CHARS).to_numpy(zero_copy_only=False)
                    parts, n = _cut(words.filter(pa.array(~short)).to_pylist(), counts[~short])
                    found = pa.concat_arrays([words.filter(pa.array(short)).cast(pa.string()), pa.array(parts, pa.string())])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), found, pa.array(np.concatenate([counts[short], n]))],
                        names=["lang", "word", "n"])
            give_back()

    counted = rows.mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, scratch: Scratch, vocabulary: Vocabulary, sample: int = SAMPLE_DOCS,
        rounds: int = ROUNDS) -> LanguageModel:
    """Piece probabilities of each language from text and lang of labelled rows.

    About ``sample`` rows of a language are drawn by a hash of their text, all of them if there are fewer; the
    priors count all rows. Rows without text or lang are not used. The model has vocabulary x languages
    numbers and is held by the driver; without labelled rows it has no language.
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    prior = np.log(np.array([totals[x] for x in languages], float) + 1) if languages else np.zeros(0)
    prior = prior - np.log(np.exp(prior).sum()) if languages else prior
    size = len(vocabulary.pieces)
    chance = F.lit(0.0)
    for lang in languages:
        chance = F.when(F.col("lang") == lang, min(1.0, sample / totals[lang])).otherwise(chance)
    drawn = known.where((F.xxhash64(F.lit(2), "text").bitwiseAND((1 << 30) - 1)) / F.lit(float(1 << 30)) < chance)
    words = scratch.stage(_word_counts(drawn, vocabulary).repartition(scratch.spark.sparkContext.defaultParallelism * 2), "words")
    # To begin with, a piece is as likely as its length lets it be.
    uses = {x: np.where(vocabulary.lengths[:size] > 0, 1.0, 0.0) for x in languages}
    for _ in range(rounds if languages else 0):
        table = {x: _probabilities(uses[x], vocabulary) for x in languages}
        shared = scratch.spark.sparkContext.broadcast((table, vocabulary.__dict__))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table, fields = shared.value
            vocabulary = Vocabulary(**fields)
            found = {x: np.zeros(len(vocabulary.pieces) + 1) for x in table}
            for batch in batches:
                texts, langs, n = (batch.column(c).to_pylist() for c in ("word", "lang", "n"))
                langs, n = np.array(langs, object), np.array(n, float)
                for a, b in _blocks(texts):
                    lattice = Lattice(texts[a:b], vocabulary)
                    for lang in set(langs[a:b]):
                        here = langs[a:b][lattice.word] == lang
                        weights = np.where(here, table[lang][lattice.piece], 0.0)
                        uses = lattice.expected(weights, n[a:b])
                        found[lang] += np.bincount(lattice.piece[here], uses[here], len(found[lang]))
            for lang, counts in found.items():
                used = np.flatnonzero(counts[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "piece", "uses"])

        # Added up as decimals, so that reruns agree; the driver gets the model's numbers only.
        summed = words.mapInArrow(expect, "lang string, piece bigint, uses double").groupBy("lang", "piece").agg(
            F.sum(F.col("uses").cast("decimal(30,12)")).cast("double").alias("uses")).toArrow()
        uses = {x: np.zeros(size) for x in languages}
        of, piece, n = summed["lang"].to_numpy(), summed["piece"].to_numpy(), summed["uses"].to_numpy()
        for lang in languages:
            uses[lang][piece[of == lang]] = n[of == lang]
        shared.unpersist()
    scratch.drop()
    probability = np.array([_probabilities(uses[x], vocabulary) for x in languages]).reshape(len(languages), size + 1)
    return LanguageModel(languages, prior, np.ascontiguousarray(probability.T))


def _probabilities(uses: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Smoothed shares of the pieces, and the constant for unknown characters."""
    matched = np.where(vocabulary.lengths[:len(uses)] > 0, uses + _PRIOR, 0.0)
    return np.append(matched / matched.sum(), _STRANGE)


def predict(docs: DataFrame, model: LanguageModel, vocabulary: Vocabulary) -> DataFrame:
    """The rows with lang_pred and score: the likeliest language of the whole text and its posterior.

    A text that is null or has no letter is ``und`` with score 0, and so is every text under a model without
    languages. Ties go to the first language by name. Only the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.__dict__, vocabulary.__dict__))
    docs = docs.drop("lang_pred", "score")
    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocabulary = LanguageModel(**shared.value[0]), Vocabulary(**shared.value[1])
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                best, score = _posterior(part.column("text"), model, vocabulary)
                yield pa.RecordBatch.from_arrays([*part.columns, best, score],
                                                 names=[*part.schema.names, "lang_pred", "score"])
            give_back()

    return docs.mapInArrow(run, schema)


def _posterior(texts: pa.Array, model: LanguageModel, vocabulary: Vocabulary) -> tuple[pa.Array, pa.Array]:
    lettered = pc.fill_null(pc.match_substring_regex(texts, _HAS_LETTER), False).to_numpy(zero_copy_only=False)
    if not model.languages:
        return pa.array([UNKNOWN] * len(texts), pa.string()), pa.array(np.zeros(len(texts)))
    words, codes, rows = split_chunks(_lowered(texts), alone(vocabulary), any_space=True)
    listed = words.to_pylist()
    scores = np.zeros((len(listed) + 1, len(model.languages)))
    for a, b in _blocks(listed):
        scores[a:b] = Lattice(listed[a:b], vocabulary).log_likelihood(model.probability)
    # The last row of scores is zero; it keeps the sums of empty texts apart.
    total = np.add.reduceat(scores[np.append(codes, len(listed))], np.minimum(rows[:-1], len(codes)), axis=0)
    total[rows[1:] == rows[:-1]] = 0.0
    total = total + model.log_prior
    best = total.argmax(axis=1)
    posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    named = np.array([*model.languages, UNKNOWN], object)[np.where(lettered, best, len(model.languages))]
    return pa.array(named, pa.string()), pa.array(np.where(lettered, posterior, 0.0))


def identify(docs: DataFrame, labelled: DataFrame, scratch: Scratch, model_path: str = MODEL) -> DataFrame:
    """Fit on the labelled rows, predict for all documents."""
    vocabulary = load_vocabulary(model_path)
    return predict(docs, fit(labelled, scratch, vocabulary), vocabulary)
