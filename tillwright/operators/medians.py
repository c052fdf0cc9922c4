"""Exact medians over columns of any size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def exact_medians(df: DataFrame, columns, weight: str | None = None) -> dict:
    """Exact median of each column, NULL and NaN ignored, None if empty.

    A built-in exact percentile holds every distinct value of a column in one
    task. Here each pass counts rows in at most 4,096 equal buckets per open
    column (a map-side aggregation), and the next pass looks only inside the
    bucket that holds the middle rank, until that bucket is a single value.
    The driver sees bucket counts only. With ``weight``, a row stands for that
    many equal rows. ``df`` is read once per pass, so it should be a table.
    """
    copies = F.lit(1) if weight is None else F.col(weight)
    values = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    stats = df.agg(
        *[F.coalesce(F.sum(F.when(values[c].isNotNull(), copies)), F.lit(0)).alias(f"n_{c}") for c in columns],
        *[F.min(values[c]).alias(f"lo_{c}") for c in columns],
        *[F.max(values[c]).alias(f"hi_{c}") for c in columns],
    ).first()

    found = {}
    open_ranges = {}
    for c in columns:
        n = stats[f"n_{c}"]
        for rank in {(n - 1) // 2, n // 2} if n else ():
            open_ranges[(c, rank)] = (stats[f"lo_{c}"], stats[f"hi_{c}"], rank)

    while open_ranges:
        for target, (low, high, _) in list(open_ranges.items()):
            if low == high:
                found[target] = low
                del open_ranges[target]
        spans = sorted({(c, low, high) for (c, _), (low, high, _) in open_ranges.items()})
        if not spans:
            break
        buckets = [
            F.struct(
                F.lit(i).alias("span"),
                F.when(
                    values[c].between(low, high),
                    F.floor((values[c] - low) / (high - low) * (BUCKETS - 1)),
                ).alias("bucket"),
                values[c].alias("value"),
                copies.alias("copies"),
            )
            for i, (c, low, high) in enumerate(spans)
        ]
        counts = (
            df.select(F.inline(F.array(*buckets)))
            .filter(F.col("bucket").isNotNull())
            .groupBy("span", "bucket")
            .agg(F.sum("copies").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            .orderBy("span", "bucket")
            .collect()
        )
        for target, (low, high, rank) in list(open_ranges.items()):
            span = spans.index((target[0], low, high))
            for row in counts:
                if row["span"] != span:
                    continue
                if rank < row["n"]:
                    open_ranges[target] = (row["lo"], row["hi"], rank)
                    break
                rank -= row["n"]

    medians = {}
    for c in columns:
        n = stats[f"n_{c}"]
        medians[c] = (found[(c, (n - 1) // 2)] + found[(c, n // 2)]) / 2 if n else None
    return medians
