"""Mixing sources to target weights.

The weight of a source is its token share to the power of an exponent, made to
add up to one. The exponent (1: as the corpus is, 0: all sources alike) is found
by bisection, many points at a time, as the smallest one whose mixture keeps a
repetition limit, or the largest one whose mixture reaches a target entropy. The
weights become token budgets, and the budgets passes over the source: whole
passes first, then a part of one. A pass is a permutation of the source's blocks,
with the rows of a block permuted in turn; the partial pass ends where the budget
does. Everything that decides about a row is a few numbers per source, so rows
are never ranked against each other.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.shared import staged

#: Passes over the smallest source, at most, for one over the largest.
REPETITIONS = 2.0
#: Blocks of a source; also the fraction of a source that one task may rank.
BLOCKS = 1024
#: Exponents tried at once, and times the interval between two is divided again.
POINTS, ROUNDS = 32, 4
#: Bytes of text that count as a token where no column of counts is given.
BYTES_A_TOKEN = 4


def token_estimate(text="text") -> Column:
    return F.ceil(F.octet_length(F.coalesce(F.col(text), F.lit(""))) / BYTES_A_TOKEN).cast("long")


def _keyed(docs: DataFrame, tokens: Column | None) -> DataFrame:
    """The small columns that decide: source (null is a source), place, block, tokens."""
    place = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    return docs.select(
        _source().alias("_source"),
        place.alias("_place"),
        F.pmod(F.xxhash64(place), F.lit(BLOCKS)).cast("int").alias("_block"),
        (token_estimate() if tokens is None else tokens.cast("long")).alias("_tokens"),
    )


def _source() -> Column:
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))


def _turn(pass_no: Column) -> Column:
    """A block's place in the permutation of a pass."""
    return F.xxhash64("_source", "_block", pass_no)


def exponent(totals: DataFrame, repetitions: float | None, entropy: float | None) -> float:
    """The exponent for totals (_source, total); rounded to six places.

    Each round tries ``POINTS`` exponents in one aggregation over the sources and
    goes on between the two where the condition changes. The driver sees the sums
    for these exponents only, however many sources there are.
    """
    if (repetitions is None) == (entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    top = totals.filter("total > 0").agg(F.max("total"), F.min("total")).first()
    if top[0] is None:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / POINTS
        points = [low + step * i for i in range(POINTS + 1)]
        tried = totals.filter("total > 0").select(
            "total", F.posexplode(F.array(*[F.lit(p) for p in points])).alias("i", "e")
        )
        # Relative to the largest source, so that large totals stay in range.
        share = F.pow(F.col("total") / F.lit(float(top[0])), F.col("e"))
        rows = (
            tried.withColumn("share", share)
            .groupBy("i")
            .agg(
                F.sum("share").alias("s"),
                F.sum(F.col("share") * F.log("share")).alias("sl"),
                F.max(F.col("share") / F.col("total")).alias("most"),
                F.min(F.col("share") / F.col("total")).alias("least"),
            )
            .collect()
        )
        if repetitions is not None:
            met = sorted(r.i for r in rows if r.most / r.least <= repetitions * (1 + 1e-12))
            at = met[0] if met else POINTS  # a larger exponent repeats less
            low, high = points[max(0, at - 1)], points[at]
        else:
            met = sorted(r.i for r in rows if math.log(r.s) - r.sl / r.s >= entropy - 1e-12)
            at = met[-1] if met else 0  # a smaller exponent has more entropy
            low, high = points[at], points[min(POINTS, at + 1)]
        if low == high:
            break
    return round(high if repetitions is not None else low, 6)


def plan(docs: DataFrame, repetitions=REPETITIONS, entropy=None, budget=None, tokens: Column | None = None) -> DataFrame:
    """One row per source: its weight, budget, whole passes, and where the partial
    pass ends (the turn and number of the block that is cut, and the last row in it).

    Without ``budget`` (tokens of the mixture) the mixture is as large as it must
    be for every row to occur: the least repeated source is passed over once.
    """
    rows = _keyed(docs, tokens)
    blocks = staged(
        rows.groupBy("_source", "_block").agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")),
        "mix-blocks",
    )
    totals = blocks.groupBy("_source").agg(F.sum("tokens").alias("total"))
    e = exponent(totals, repetitions, entropy)
    power = F.pow(F.col("total").cast("double"), F.lit(e))
    power = F.when(F.col("total") > 0, power).otherwise(F.lit(0.0))
    norm = totals.agg(F.sum(power).alias("s"), F.max(F.when(power > 0, F.col("total") / power)).alias("m")).first()
    size = budget if budget is not None else (norm.s or 0.0) * (norm.m or 0.0)
    weight = F.when(F.lit(bool(norm.s)), power / F.lit(norm.s or 1.0)).otherwise(F.lit(0.0))
    wanted = totals.select("_source", "total", weight.alias("weight")).withColumn(
        "budget", F.round(F.col("weight") * F.lit(float(size))).cast("long")
    )
    # A source without a token is passed over once: its rows cost nothing.
    whole = F.when(F.col("total") > 0, F.floor(F.col("budget") / F.greatest("total", F.lit(1)))).otherwise(F.lit(1))
    wanted = wanted.withColumn("passes", whole.cast("int")).withColumn(
        "rest", F.when(F.col("total") > 0, F.col("budget") - F.col("passes") * F.col("total")).otherwise(F.lit(0))
    )
    turns = blocks.join(wanted, "_source").withColumn("turn", _turn(F.col("passes")))
    by_turn = Window.partitionBy("_source").orderBy("turn", "_block")  # BLOCKS rows at most
    turns = turns.withColumn("upto", F.sum("tokens").over(by_turn))
    cut = (
        turns.filter("upto > rest")
        .groupBy("_source")
        .agg(F.min(F.struct("turn", "_block", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"))).alias("c"))
        .select("_source", F.col("c.turn").alias("cut_turn"), F.col("c._block").alias("cut_block"), "c.left")
    )
    cut = staged(cut, "mix-cut")
    inside = rows.join(cut, (rows["_source"] == cut["_source"]) & (rows["_block"] == cut["cut_block"])).select(
        rows["_source"].alias("_source"), "_place", "_tokens", "left"
    )
    by_place = Window.partitionBy("_source").orderBy("_place")  # one block of each source; repeated rows go together
    last = (
        inside.withColumn("upto", F.sum("_tokens").over(by_place))
        .filter("upto <= left")
        .groupBy("_source")
        .agg(F.max("_place").alias("cut_place"))
    )
    return staged(
        wanted.join(cut, "_source", "left").join(last, "_source", "left").withColumn("exponent", F.lit(e)), "mix-plan"
    )


def with_copies(docs: DataFrame, sources: DataFrame, tokens: Column | None = None) -> DataFrame:
    """(_row: the row of ``docs``, n_tokens, weight, copies) for each row."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    keyed = docs.select(
        row,
        _source().alias("_source"),
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("_place"),
        (token_estimate() if tokens is None else tokens.cast("long")).alias("n_tokens"),
    ).withColumn("_block", F.pmod(F.xxhash64("_place"), F.lit(BLOCKS)).cast("int"))
    joined = keyed.join(sources, "_source").withColumn("turn", _turn(F.col("passes")))
    before = (F.col("turn") < F.col("cut_turn")) | (
        (F.col("turn") == F.col("cut_turn")) & (F.col("_block") < F.col("cut_block"))
    )
    inside = (F.col("_block") == F.col("cut_block")) & (F.col("_place") <= F.col("cut_place"))
    part = F.when(F.col("cut_turn").isNull(), F.lit(False)).otherwise(before | F.coalesce(inside, F.lit(False)))
    return joined.select("_row", "n_tokens", "weight", (F.col("passes") + part.cast("int")).alias("copies"))


def mixing_plan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, n_tokens, weight (of its source), copies: how often the row
    occurs in the mixture. One row per row of ``docs`` (doc_id, text, source).

    A null source is a source of its own, a null text is empty, and an empty text
    costs nothing. Repeated rows are decided alike. An empty table gives no rows.
    Other columns aren't read. Copies follow from hashes: the same rows always get
    the same copies.
    """
    found = with_copies(docs.select("doc_id", "source", "text"), plan(docs, **options))
    return found.select("_row.doc_id", "_row.source", "n_tokens", "weight", F.col("copies").cast("long").alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture: the rows of ``docs`` with their columns, each as often as planned."""
    found = with_copies(docs, plan(docs, **options)).filter("copies > 0")
    return found.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
