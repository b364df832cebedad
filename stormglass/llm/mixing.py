"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words, every document an expected number of copies. Its whole part is
taken for certain; for the rest, documents are ranked by random odds over inclusion odds, and the
ranking is cut where the words taken come nearest to the target. The cut is found on sums of rank
bins, each round splitting the bin that holds it, so no source is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormglass.llm.scratch import Scratch

# Weights of the sources by order, share of all words, most copies of a document.
WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), 1.5, 2

_DIGIT_BITS, _RANK_BITS = 6, 48
_BINS, _LEVELS = 1 << _DIGIT_BITS, _RANK_BITS // _DIGIT_BITS
#: Share of a target by which the expected words may miss it; the words taken are cut at the target itself.
TOLERANCE = 0.001
#: A bin of so few rows is ordered in one task.
FEW_ROWS = 1000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def length_weight(size: Column) -> Column:
    """Inclusion weight of a document by its words: their square root, so longer documents are likelier to be taken."""
    return F.sqrt(F.greatest(F.coalesce(size, F.lit(0)), F.lit(1)).cast("double"))


def uniform(seed: int, *columns: str) -> Column:
    """A number between 0 and 1 from the values of a row; equal rows get equal numbers."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12) + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
) -> DataFrame:
    """Target of each source: shares by weight, stopped at ``most`` times its size, the excess reshared.

    sizes: source, source_size; a row per source, so one task orders them. Filling all sources up
    to a common level per weight is what resharing until none is above comes to. Sources go by code point,
    null last. Without words all targets are 0.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    full = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (
        sizes.withColumn("w", weight).withColumn("limit", F.col("source_size") * most)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("total") * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
                    / F.sum("w").over(rest))
        # The first source that the level does not fill sets the level of all that follow.
        .withColumn("open", F.col("level") * F.col("w") <= F.col("limit"))
        .withColumn("first", F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("w"), "source", "level")))
                    .over(everything))
    )
    level = F.col("first.level")
    target = F.when(level.isNull() | (F.col("limit") < level * F.col("w")), F.col("limit").cast("double"))
    return filled.select("source", "source_size", target.otherwise(level * F.col("w")).alias("target"))


def _rates(rows: DataFrame, sources: DataFrame, most: int, tolerance: float, scratch: Scratch) -> DataFrame:
    """Expected copies of a document of weight 1 per source, so that expected words meet the target.

    Documents of large weight stop at ``most`` copies; each round shares the rest anew, until those that stop in a source have no
    more than ``tolerance`` of its target. Rounds work on sums by weight.
    """
    summed = rows.groupBy("m_source", "m_weight").agg(F.sum("m_size").alias("m_size"), F.count("*").alias("m_n"))
    summed = scratch.stage(summed, "weights")
    rates = sources.withColumn("rate", F.lit(0.0)).withColumn("stopped", F.lit(-1).cast("long")).withColumn("fixed", F.lit(0).cast("long"))
    while True:
        stopped = (F.col("m_weight") * F.col("rate") >= most) & (F.col("rate") > 0)
        words = F.col("m_size")
        found = (
            summed.join(rates, F.col("m_source").eqNullSafe(F.col("source")))
            .groupBy("source").agg(
                F.max("source_size").alias("source_size"), F.max("target").alias("target"),
                F.max("stopped").alias("was"), F.max("fixed").alias("was_fixed"),
                F.sum(F.when(stopped, F.col("m_n")).otherwise(0)).alias("stopped"),
                F.coalesce(F.sum(F.when(stopped, words * most)), F.lit(0)).cast("long").alias("fixed"),
                F.coalesce(F.sum(F.when(~stopped, words * F.col("m_weight"))), F.lit(0.0)).alias("open"))
        )
        # Where every document has stopped, the rate only has to keep them all there, in further rounds for other sources too.
        rate = F.when(F.col("open") > 0, F.greatest(F.col("target") - F.col("fixed"), F.lit(0.0)) / F.col("open")).when(
            F.col("fixed") > 0, F.lit(float("inf")))
        more = (F.col("was") < 0) | (F.col("fixed") - F.col("was_fixed") > F.col("target") * F.lit(tolerance))
        rates = scratch.stage(
            found.select("source", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate"), "stopped", "fixed",
                         ((F.col("stopped") != F.col("was")) & more).alias("moved")), "rates")
        if rates.where("moved AND rate > 0").isEmpty():
            return rates.select("source", "source_size", "target", "rate")
        rates = rates.drop("moved")


def pareto_mix(rows: DataFrame, scratch: Scratch, most: int = MOST_COPIES, share: float = SHARE,
               weights: tuple[int, ...] = WEIGHTS, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows with source_size, target and copies (0 to ``most``), mixed to the targets of their sources.

    rows: source, size (words), weight (inclusion weight within the source, above 0), u (random, between
    0 and 1; a function of the document, so that reruns agree) and whatever else is to be kept; columns named
    source_size, target or copies are replaced, names that begin with m_ are reserved. A null source is a source of its own; null sizes count 0; rows of equal
    rank are taken in any order, so repeated rows may get different copies. Documents
    without words get their certain copies only. An empty table gives an empty table.
    """
    kept = [c for c in rows.columns if c not in ("source_size", "target", "copies")]
    rows = rows.withColumns({
        "m_source": F.col("source"), "m_size": F.coalesce(F.col("size"), F.lit(0)).cast("long"),
        "m_weight": F.col("weight").cast("double"), "m_u": F.col("u"),
        "m_tie": F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - _RANK_BITS),
    })
    rows = scratch.stage(rows, "rows")
    sizes = rows.groupBy(F.col("m_source").alias("source")).agg(F.sum("m_size").alias("source_size"))
    sources = scratch.stage(source_targets(sizes, weights, share, most), "targets")
    rates = _rates(rows, sources, most, tolerance, scratch)
    rates = rates.select(*(F.col(c).alias(f"m_of_{c}") for c in rates.columns))

    expected = F.least(F.lit(float(most)), F.col("m_of_rate") * F.col("m_weight"))
    part = F.col("m_expected") - F.col("m_sure")
    odds = F.col("m_u") / (1 - F.col("m_u")) / (part / (1 - part))
    rank = F.when(part > 0, odds / (1 + odds)).otherwise(1.0)
    ranked = (
        rows.join(rates, F.col("m_source").eqNullSafe(F.col("m_of_source")))
        .withColumn("m_expected", expected).withColumn("m_sure", F.floor("m_expected"))
        .withColumn("m_rank", F.least(F.lit((1 << _RANK_BITS) - 1), F.floor(rank * F.lit(float(1 << _RANK_BITS)))))
        .withColumn("m_can", (part > 0) & (F.col("m_size") > 0))
    )
    cuts = _cuts(ranked, scratch)
    scratch.drop("rows", "rates", "cuts")
    chosen = F.struct("m_rank", "m_tie") <= F.struct("m_cut_rank", "m_cut_tie")
    return (
        ranked.join(cuts, F.col("m_source").eqNullSafe(F.col("m_cut_source")), "left")
        .select(*kept, F.col("m_of_source_size").alias("source_size"), F.col("m_of_target").alias("target"),
                (F.col("m_sure") + F.coalesce((F.col("m_can") & chosen).cast("long"), F.lit(0))).alias("copies"))
    )


def _digit(level: int) -> Column:
    """Bits of the rank, then of the tie number, from the top."""
    column, place = ("m_rank", level) if level < _LEVELS else ("m_tie", level - _LEVELS)
    return F.shiftright(column, _RANK_BITS - _DIGIT_BITS * (place + 1)).bitwiseAND(_BINS - 1)


def _cuts(ranked: DataFrame, scratch: Scratch) -> DataFrame:
    """Last row that is taken in each source (m_cut_source, m_cut_rank, m_cut_tie), none if no row is."""
    wanted = ranked.groupBy("m_source").agg(
        (F.max("m_of_target") - F.sum(F.col("m_sure") * F.col("m_size"))).alias("left"))
    state = scratch.stage(wanted.select(F.col("m_source").alias("s"), "left"), "left")
    rows = ranked.where("m_can").select("m_source", "m_size", "m_rank", "m_tie")
    in_order = Window.partitionBy("s").orderBy("digit")
    for level in range(2 * _LEVELS):
        inside = rows.join(state.select("s", "left", *_digits(level)), F.col("m_source").eqNullSafe(F.col("s")))
        for k in range(level):
            inside = inside.where(_digit(k) == F.col(f"d{k}"))
        bins = (
            inside.groupBy("s", _digit(level).alias("digit"), "left", *_digits(level))
            .agg(F.sum("m_size").alias("words"), F.count("*").alias("n"))
            .withColumn("upto", F.sum("words").over(in_order))
            .withColumn("last", F.max("digit").over(Window.partitionBy("s")))
            # The bin that reaches what is left, or the last one if all of them do not.
            .where("upto - words < left AND (upto >= left OR digit = last)")
        )
        state = scratch.stage(
            bins.select("s", (F.col("left") - F.col("upto") + F.col("words")).alias("left"), *_digits(level),
                        F.col("digit").alias(f"d{level}"), "n"), "cut")
        most = state.agg(F.max("n")).first()[0]
        if (most or 0) <= FEW_ROWS:
            break
    depth = level + 1
    inside = rows.join(state, F.col("m_source").eqNullSafe(F.col("s")))
    for k in range(depth):
        inside = inside.where(_digit(k) == F.col(f"d{k}"))
    ordered = Window.partitionBy("m_source").orderBy("m_rank", "m_tie")
    upto = F.sum("m_size").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    # A row is taken if the words come nearer to the target with it than without.
    taken = inside.withColumn("upto", upto).where("upto - m_size / 2 <= left")
    last = taken.groupBy("m_source").agg(F.max(F.struct("m_rank", "m_tie")).alias("cut"))
    first = (1 << _RANK_BITS) - 1
    low = [F.lit(0).cast("long"), F.lit(0).cast("long")]
    for k in range(depth):
        at, shift = (0, k) if k < _LEVELS else (1, k - _LEVELS)
        low[at] = low[at] + F.shiftleft(F.col(f"d{k}"), _RANK_BITS - _DIGIT_BITS * (shift + 1))
    # If no row of the bin is taken, the cut lies just before the bin.
    if depth <= _LEVELS:
        before = F.struct((low[0] - 1).alias("m_rank"), F.lit(first).alias("m_tie"))
    else:
        before = F.struct(low[0].alias("m_rank"), (low[1] - 1).alias("m_tie"))
    last = last.select(F.col("m_source").alias("t"), "cut")
    cut = F.coalesce("cut", before)
    found = (
        state.join(last, F.col("s").eqNullSafe(F.col("t")), "left")
        .select(F.col("s").alias("m_cut_source"), cut["m_rank"].alias("m_cut_rank"), cut["m_tie"].alias("m_cut_tie"))
    )
    return scratch.stage(found, "cuts")


def _digits(level: int) -> list[str]:
    return [f"d{k}" for k in range(level)]
