"""Document fingerprints by consistent weighted sampling.

A text is a set of terms, its words, weighted by how often they occur. For each
sample k and term, a hash gives numbers that depend on nothing else: c and r, both
Gamma(2, 1), and b, uniform. A weight S is rounded down, on a scale of its
logarithm, to y = exp(r (t - b)) with t = floor(ln S / r + b), and the term's value
is a = c exp(-r) / y. The sample is the least value over all terms. Two texts have
the same one with the probability of their generalised Jaccard similarity, the sum
of the lesser over the sum of the greater weights, so the share of equal samples
estimates it.

The numbers come from independent uniforms: r = e1 + e2 and b = e2 / r, with e1 and
e2 exponential, have the required joint law. Then exp(-r (1 - b)) is the uniform
behind e1, t is 0 exactly if that uniform times S is below 1, and a needs just one
logarithm in this, the frequent case.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.shared import blocks_for, id_and_text, staged

SAMPLES = 64
#: Rows in a block of neighbours on average, and cuts at most on each of two levels.
BLOCK_ROWS, CUTS = 500, 2048
#: Bytes of text in a partition on average: its terms are held while they are counted.
PARTITION_BYTES = 6 << 20

_BITS = 21


def _uniform(hashed: str, place: int) -> str:
    mask, scale = (1 << _BITS) - 1, float(1 << _BITS)
    return f"((shiftrightunsigned({hashed}, {place * _BITS}) & {mask}L) + 0.5D) / {scale}D"


def _value(k: int) -> str:
    """The value of ``term`` with ``weight`` in sample k, as SQL over ``h<k>``, the hash of the
    sample and the term.

    A value beyond ``enough`` is the least of a text with probability e^-20 only. It
    isn't worked out: a lower bound that needs no logarithm stands for it.
    """
    u1, u3, u4 = (f"({_uniform(f'h{k}', i)})" for i in range(3))
    product = f"({u3} * {u4})"
    u2 = f"({_uniform(f'xxhash64(h{k})', 0)})"
    low, bound = f"(-ln({product}) * {u1})", f"((1D - {product}) * {u1})"
    r = f"(-ln({u1} * {u2}))"
    t = f"floor((ln(weight) - ln({u2})) / {r})"
    return (
        f"CASE WHEN {u1} * weight < 1D THEN IF({bound} > enough, {bound}, {low}) "
        f"WHEN {bound} * {u2} / weight > enough THEN {bound} * {u2} / weight "
        f"ELSE {low} * exp(-{r} * {t}) END"
    )


def samples(rows: DataFrame, keys: list[str], text: str, n: int = SAMPLES) -> DataFrame:
    """The samples, array<double>, of each group of ``keys``. ``rows`` has one row per
    key with its text; a text without a word has one term of its own. Nothing is
    shuffled if rows are partitioned by some of the keys."""
    words = rows.select(*keys, F.split(F.lower(text), r"\s+").alias("words"))
    each = words.select(*keys, (F.lit(20.0) / F.size("words")).alias("enough"), F.explode("words").alias("word"))
    blank = F.col("word") == ""
    terms = (
        each.select(*keys, "enough", F.when(blank, F.lit(0).cast("long")).otherwise(F.xxhash64("word")).alias("term"))
        .groupBy(*keys, "enough", "term")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    # Hashed once, and in fewer columns than generated code takes (spark.sql.codegen.maxFields).
    terms = terms.select("*", *[F.expr(f"xxhash64({k}, term)").alias(f"h{k}") for k in range(n)])
    least = [F.expr(f"min({_value(k)})").alias(f"s{k}") for k in range(n)]
    return terms.groupBy(*keys).agg(*least).select(*keys, F.array(*[f"s{k}" for k in range(n)]).alias("samples"))


def as_string(samples_: str) -> Column:
    """Eight hexadecimal digits for each sample."""
    digits = lambda x: F.lpad(F.lower(F.hex(F.xxhash64(x).bitwiseAND(0xFFFFFFFF))), 8, "0")
    return F.array_join(F.transform(samples_, digits), "")


def likeness(a: str, b: str) -> Column:
    """The share of equal samples: an estimate of the generalised Jaccard similarity."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return same / F.size(a)


def fingerprints(docs: DataFrame, n: int = SAMPLES) -> DataFrame:
    """doc_id, fingerprint, samples: one row per distinct doc_id and text of ``docs``."""
    texts = id_and_text(docs).distinct().withColumn("_text", F.xxhash64("text"))
    found = samples(texts, ["doc_id", "_text"], "text", n)
    return found.select("doc_id", as_string("samples").alias("fingerprint"), "samples")


def _cuts(rows: DataFrame, key: str, n: int):
    """Up to ``n`` - 1 quantiles of ``key``, as an aggregate."""
    return F.array_distinct(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], max(10_000, 8 * n)))


def _below(cuts: Column, key: Column) -> Column:
    """How many of the ascending cuts are below ``key``."""
    return F.size(F.filter(cuts, lambda c: c < key))


def blocks_of_ids(texts: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``texts`` with a column ``block``, blocks of about ``block_rows`` rows in the order of
    ``key``; rows of one key share a block.

    The keys are cut at quantiles, and each piece at quantiles of its own, so the
    bounds of up to CUTS * CUTS blocks fit a table of CUTS rows.
    """
    wanted = max(1, -(-texts.count() // block_rows))
    wide = min(CUTS, max(1, int(wanted**0.5)))
    first = texts.agg(_cuts(texts, "key", wide).alias("cuts")).first().cuts if wide > 1 else []
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(first or [])]) if first else F.array().cast("array<bigint>")
    pieces = texts.withColumn("piece", _below(bounds, F.col("key")))
    narrow = min(CUTS, -(-wanted // wide))
    inside = pieces.groupBy("piece").agg((_cuts(pieces, "key", narrow) if narrow > 1 else F.array().cast("array<bigint>")).alias("cuts"))
    inside = staged(inside, "cuts")  # CUTS rows of CUTS numbers at most: 32 MB
    placed = pieces.join(F.broadcast(inside), "piece")
    return placed.withColumn("block", F.col("piece").cast("long") * CUTS + _below(F.col("cuts"), F.col("key"))).drop("piece", "cuts")


def _guests(texts: DataFrame) -> DataFrame:
    """(block, key, visits): the greatest key of each block, which comes first in it, and the
    block of the smaller keys next to it, for the last one the first: the block that its
    first row visits is the one before it in descending order."""
    firsts = texts.groupBy("block").agg(F.max("key").alias("key"))
    firsts = staged(firsts.withColumn("piece", F.floor(F.col("block") / CUTS)), "firsts")
    # At most CUTS rows: where each piece's blocks begin, and those of the piece after it, around.
    pieces = firsts.groupBy("piece").agg(F.min("block").alias("start"))
    after = F.coalesce(F.lead("start").over(Window.orderBy("piece")), F.min("start").over(Window.partitionBy()))
    pieces = pieces.select("piece", after.alias("start_after"))
    inside = F.lead("block").over(Window.partitionBy("piece").orderBy("block"))
    visits = firsts.withColumn("inside", inside).join(F.broadcast(pieces), "piece")
    return visits.select("block", "key", F.coalesce("inside", "start_after").alias("visits"))


def with_neighbour(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (block, place, guest, doc_id, text, next_text) in descending order of doc_id.

    Ids are cut into blocks at quantiles. The first row of a block also visits the
    block before it, as a guest at its end, and that of the first block the last one;
    so every row finds its successor within its block. Null ids come last, and rows
    of equal ids are ordered by text.
    """
    texts = id_and_text(docs).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    partitions = blocks_for(texts, PARTITION_BYTES)
    texts = blocks_of_ids(texts, block_rows)
    seats = texts.join(_guests(texts), ["block", "key"], "left").select(
        "doc_id", "text", "key",
        F.explode(
            F.when(F.col("visits").isNull(), F.array(F.struct(F.col("block"), F.lit(False).alias("guest"))))
            .otherwise(
                F.array(
                    F.struct(F.col("block"), F.lit(False).alias("guest")),
                    F.struct(F.col("visits").alias("block"), F.lit(True).alias("guest")),
                )
            )
        ).alias("seat"),
    )
    order = Window.partitionBy("block").orderBy("guest", F.desc("key"), "text")
    dealt = seats.select("seat.block", "seat.guest", "key", "doc_id", "text").repartition(partitions, "block")
    return dealt.select(
        "block",
        F.row_number().over(order).alias("place"),
        "guest",
        "doc_id",
        "text",
        F.lead("text").over(order).alias("next_text"),
    )


def edited(text: str, other: str) -> Column:
    """``text`` with its last half replaced by as many code points of ``other``, or all of it."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(
        F.substring(F.col(text), F.lit(1), F.char_length(text) - half), F.substring(F.col(other), F.lit(1), half)
    )


def fingerprints_of_edits(docs: DataFrame, n: int = SAMPLES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next: one row per row of ``docs`` (doc_id, text).

    The edited text mixes the row's text with its successor's in descending order of
    doc_id (``with_neighbour`` says where nulls and repeated ids go; a single row is
    its own successor). A null text is an empty one, and all texts without a word have
    one fingerprint. An empty table gives no rows; other columns aren't read. Texts
    are shuffled once, by block; terms never are.
    """
    rows = with_neighbour(docs, block_rows).withColumn("other", edited("text", "next_text"))
    both = F.array(F.col("text"), F.col("other"))
    variants = rows.select(
        "block", "place", F.posexplode(F.when(F.col("guest"), F.slice(both, 1, 1)).otherwise(both)).alias("variant", "of")
    )
    found = samples(variants, ["block", "place", "variant"], "of", n)
    order = Window.partitionBy("block").orderBy("place", "variant")
    placed = found.select(
        "*",
        F.lead("samples", 1).over(order).alias("edited_samples"),
        F.lead("samples", 2).over(order).alias("next_samples"),
    ).filter("variant = 0")
    facts = rows.filter("NOT guest").select(
        "block", "place", "doc_id",
        F.char_length("text").cast("long").alias("n_chars"), F.sha2("other", 256).alias("edited_sha256"),
    )
    return facts.join(placed, ["block", "place"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string("samples").alias("fingerprint"),
        as_string("edited_samples").alias("edited_fingerprint"),
        likeness("samples", "edited_samples").alias("near_edited"),
        likeness("samples", "next_samples").alias("near_next"),
    )
