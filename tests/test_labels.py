"""Frequent words by sketches are the exact ones, or are counted in full."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stormglass.operators import archive


@pytest.mark.parametrize("tracked, candidates", [(10_000, 64), (60, 20), (12, 4)])
def test_labels_are_those_of_exact_counts(spark, tracked, candidates):
    pick = random.Random(tracked)
    words = ["".join(pick.choices("abcdefghij", k=6)) for _ in range(300)]
    rows = []
    for day in range(4):
        # Two dates with clear winners, one where all words are about as frequent, one with three words.
        weights = [[1 / (k + 1) ** 2 for k in range(300)], [1 / (k + 1) for k in range(300)], [1] * 300, [1] * 3 + [0] * 297][day]
        for _ in range(400):
            rows.append((dt.date(2020, 1, 1 + day), " ".join(pick.choices(words, weights, k=5))))
    around = spark.createDataFrame(rows, "event_date date, title string").repartition(7)
    exact = archive.auto_labels(archive.keyword_counts(around)).collect()
    counts = archive.frequent_word_counts(around, tracked=tracked, candidates=candidates)
    assert sorted(archive.auto_labels(counts).collect()) == sorted(exact)
    held = {r["event_date"].day: r["n"] for r in counts.groupBy("event_date").agg(F.count("*").alias("n")).collect()}
    if tracked == 10_000:  # the sketches hold all words, and what they name is proven
        assert max(held.values()) <= candidates
    else:  # equal words are never proven, and counted in full
        assert held[3] > 250
