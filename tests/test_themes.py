"""Classes by dictionary are those of the scan, whatever the dictionary holds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.functions import news_text
from stormglass.operators import themes

CODES = ["MILITARY", "AWARD", "SOFTWARE", "TAX_X", "SANCTION", "COUP", "diplomatic", "EXPORT_CONTROL", "EDUCATION", "", "WAR#1#X", "Ünrest"]


@pytest.fixture(scope="module")
def lists(spark):
    pick = random.Random(7)
    rows = [(";".join(pick.choices(CODES, k=pick.randint(1, 4))),) for _ in range(300)]
    rows += [(None,), ("",), (";",), ("MILITARY",), ("TAX_X;SANCTION;MILITARY",), ("MILITARY;SANCTION;TAX_X",), ("MIL;ITARY",)]
    return spark.createDataFrame(rows, "themes string").cache()


def names(frame, column="category"):
    return [r[column] for r in frame.collect()]


@pytest.mark.parametrize("learned, cells", [(20_000, 1 << 16), (3, 512), (20_000, 512)])
def test_classes_are_those_of_the_scan(lists, learned, cells):
    for classes, scan in ((themes.BATCH, news_text.batch_category), (themes.LIVE, news_text.live_category)):
        dictionary = themes.learn(lists, classes, learned=learned, cells=cells)
        assert names(themes.classify(lists, dictionary)) == names(lists.withColumn("category", scan(F.col("themes"))))
    dictionary = themes.learn(lists, themes.KEYWORDS, learned=learned, cells=cells)
    kept = themes.filter_theme_keywords(lists, dictionary).collect()
    assert kept == lists.filter(F.col("themes").rlike(f"(?i){V.LIVE_THEME_WORDS}")).collect()


def test_known_codes_are_looked_up_and_others_scanned(spark, lists):
    dictionary = themes.learn(lists, themes.BATCH)
    ranks = names(lists.select(dictionary.rank(F.col("themes")).alias("r")), "r")
    assert themes._UNKNOWN not in ranks and len({r for r in ranks if r is not None}) > 3
    other = spark.createDataFrame([("TAX_X;NEVER_SEEN_WAR",), ("NEVER_SEEN",)], "themes string")
    assert names(other.select(dictionary.rank(F.col("themes")).alias("r")), "r") == [themes._UNKNOWN] * 2
    assert names(themes.classify(other, dictionary)) == ["CONFLICT", None]


def test_an_empty_dictionary_knows_nothing(spark):
    none = spark.createDataFrame([], "themes string")
    dictionary = themes.learn(none, themes.BATCH, cells=512)
    hashes = np.arange(-5000, 5000)
    rows = spark.createDataFrame([(f"code{k};c{h}",) for k, h in enumerate(hashes.tolist())], "themes string")
    assert set(names(rows.select(dictionary.rank(F.col("themes")).alias("r")), "r")) == {themes._UNKNOWN}
    # Even codes whose hash has nothing but the bits of the cell.
    low, high = np.meshgrid(np.arange(512), [0, -512])
    codes = (low | high).ravel()
    held = dictionary.cells[codes & 511]
    assert ((held ^ codes) >> 8 != 0).all()


def test_no_class_word_holds_a_separator():
    words = "|".join(w for _, w in V.BATCH_CATEGORIES + V.LIVE_CATEGORIES) + "|" + V.LIVE_THEME_WORDS
    assert themes.SEPARATOR not in words
