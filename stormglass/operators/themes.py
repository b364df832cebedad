"""Classes of theme lists by a dictionary of theme codes.

A list holds hundreds of codes, few of them different: each different code is classified once, by the same expression that would
scan the list, and a list takes the best class of its codes by look-up. No word of the classes holds a separator, so a word
that occurs in a list occurs in one of its codes, and both ways give the same class.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormglass import fixed_values as V
from stormglass.functions import news_text

SEPARATOR = ";"
#: Cells of the dictionary (a power of two, 512 at least; 512 KB in the plan), and lists whose codes fill it. Neither changes a result: lists
#: with a code that has no cell are scanned.
CELLS, LEARNED_LISTS = 1 << 16, 20_000
_UNKNOWN, _RANK_BITS = -1, 8


@dataclass(frozen=True)
class Classes:
    """Classes in the order in which they win: their names by rank, and the rank of a text by scanning it."""

    names: tuple[str | None, ...]
    scan: Callable[[Column], Column]


def _ranked(classes: list[tuple[str, str]], default: str | None) -> Classes:
    def scan(text: Column) -> Column:
        branches = [(news_text.contains_any(text, words), rank) for rank, (_, words) in enumerate(classes)]
        (condition, first), *rest = branches
        return reduce(lambda chain, b: chain.when(*b), rest, F.when(condition, first)).otherwise(len(classes))

    return Classes((*(name for name, _ in classes), default), scan)


BATCH = _ranked(V.BATCH_CATEGORIES, None)
LIVE = _ranked(V.LIVE_CATEGORIES, V.LIVE_CATEGORY_OTHER)
#: Whether a live theme word occurs: "yes" or none.
KEYWORDS = Classes(("yes", None), lambda text: F.when(text.rlike(f"(?i){V.LIVE_THEME_WORDS}"), 0).otherwise(1))


@dataclass(frozen=True)
class Dictionary:
    """Ranks of known codes: in the cell of a code's hash, the upper bits of the hash and the rank below them."""

    classes: Classes
    cells: np.ndarray

    def rank(self, themes: Column, separator: str = SEPARATOR) -> Column:
        """Best rank among the codes of a list; _UNKNOWN if one of them is not in the dictionary, NULL for NULL."""
        cells = F.lit(self.cells)

        def known(code: Column) -> Column:
            held = F.get(cells, code.bitwiseAND(F.lit(len(self.cells) - 1)).cast("int"))
            same = F.shiftright(held.bitwiseXOR(code), _RANK_BITS) == 0
            return F.when(same, held.bitwiseAND(F.lit((1 << _RANK_BITS) - 1))).otherwise(_UNKNOWN)

        codes = F.transform(F.split(themes, separator), lambda code: F.xxhash64(code))
        return F.array_min(F.transform(codes, known)).cast("int")


def learn(lists: DataFrame, classes: Classes, column: str = "themes", separator: str = SEPARATOR,
          cells: int = CELLS, learned: int = LEARNED_LISTS) -> Dictionary:
    """The dictionary of the codes of the first lists; of codes with one cell the most frequent is held."""
    codes = lists.select(column).limit(learned).select(F.explode(F.split(column, separator)).alias("code"))
    counted = codes.groupBy("code").agg(F.count("*").alias("n")).select(
        F.xxhash64("code").alias("hash"), "n", classes.scan(F.col("code")).cast("long").alias("rank"))
    best = counted.groupBy(F.col("hash").bitwiseAND(F.lit(cells - 1)).alias("cell")).agg(
        F.max_by(F.struct("hash", "rank"), F.struct("n", "hash")).alias("best"))
    found = best.select("cell", "best.*").toArrow()  # at most a row per cell
    table = np.zeros(cells, np.int64)
    low = (1 << _RANK_BITS) - 1
    hashes, ranks = found["hash"].to_numpy(), found["rank"].to_numpy()
    # An empty cell holds a number that differs in bit 8 from every hash that looks there.
    table[:] = ~np.arange(cells) & (1 << _RANK_BITS)
    table[found["cell"].to_numpy()] = (hashes & ~low) | ranks
    return Dictionary(classes, table)


def classify(news: DataFrame, dictionary: Dictionary, column: str = "themes", into: str = "category",
             separator: str = SEPARATOR) -> DataFrame:
    """The rows with the name of their class; lists with an unknown code are scanned."""
    names = F.array(*(F.lit(name) for name in dictionary.classes.names))
    none = len(dictionary.classes.names) - 1
    ranked = news.withColumn("m_rank", dictionary.rank(F.col(column), separator))
    rank = F.when(F.col("m_rank") == _UNKNOWN, dictionary.classes.scan(F.col(column))).otherwise(F.col("m_rank"))
    return ranked.withColumn(into, F.get(names, F.coalesce(rank, F.lit(none)))).drop("m_rank")


def tag_category_batch(news: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Adds the archive category; unclassified rows are dropped."""
    return classify(news, dictionary).filter("category IS NOT NULL")


def tag_category_live(news: DataFrame, dictionary: Dictionary) -> DataFrame:
    return classify(news, dictionary)


def filter_theme_keywords(news: DataFrame, dictionary: Dictionary) -> DataFrame:
    return classify(news, dictionary, into="m_named").filter("m_named IS NOT NULL").drop("m_named")
