"""Surrogate keys and ranks without a single-task window."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwright.sources.tables import discard, staged


def _in_ranges(df: DataFrame, order_cols) -> DataFrame:
    """``df`` in the order of ``order_cols``, as a table with the number of each row's range
    and its place there.

    The rows are written once as they are, so that whatever makes them runs once:
    range bounds are sampled from that copy. The ranges are those of the files that
    come out of it, which no later run can draw differently.
    """
    given = staged(df)
    ordered = (
        given.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    placed = staged(ordered)
    discard(given)
    return placed


def _before(placed: DataFrame, size: Column) -> DataFrame:
    """(_range, _offset): what the ranges before each hold, a row for each shuffle partition."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range").agg(size.alias("_size"))
    return sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))


def surrogate_key(df: DataFrame, order_cols, name: str, start: int = 1) -> DataFrame:
    """Number the rows ``start, start+1, …`` in the order of ``order_cols``.

    ``order_cols`` must be unique. Rows are range-partitioned and sorted, so
    each task numbers its own range; the offset of a range is the row count of
    the ranges before it. The result reads a staged table, which goes with the
    others of its thread (``drop_staged``).
    """
    placed = _in_ranges(df, order_cols)
    offsets = F.broadcast(_before(placed, F.count("*")))
    return placed.join(offsets, "_range").select(
        (F.col("_offset") + F.col("_place") + start).alias(name), *df.columns
    )


def global_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` with the rank of ``value``, the greatest first; equal values share a rank, and
    as many ranks are left out after them (SQL's ``rank``). Nulls have none.

    Rows are counted by value, so a frequent value is one row of what is ordered:
    the rank is one more than the rows of greater values, summed within its range
    and over the ranges before.
    """
    values = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_rows"))
    placed = _in_ranges(values, [F.desc(value)])
    inside = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ranks = placed.join(F.broadcast(_before(placed, F.sum("_rows"))), "_range").select(
        value, (F.coalesce(F.sum("_rows").over(inside), F.lit(0)) + F.col("_offset") + 1).alias(name)
    )
    return df.join(ranks, value, "left").select(*df.columns, name)


def extend_keys(existing: DataFrame, fresh: DataFrame, order_cols, name: str) -> DataFrame:
    """Key ``fresh`` rows after the highest key of ``existing``; keys in use
    never change. Returns the fresh rows only."""
    top = existing.agg(F.max(name)).first()[0] or 0
    return surrogate_key(fresh, order_cols, name, start=top + 1)


def _packed(high: Column, *low: Column) -> Column:
    """``high`` and 16 bits for each of ``low`` in one long. A value that doesn't
    fit stops the job: it would share a key with another row."""
    key, fits = high.cast("long"), F.lit(True)
    for part in low:
        key, fits = key * 65536 + part, fits & part.between(0, 65535)
    wrong = F.raise_error(F.lit("a key field is not within 0 and 65535")).cast("long")
    return F.when(~fits, wrong).otherwise(key)


def store_version_key(store_id: Column, version: Column) -> Column:
    """Key of a store version, computed from (store_id, version) alone: no
    lookup, no shuffle, the same on every run. Holds 65,535 versions."""
    return _packed(store_id, version)


def sales_key(store_id: Column, department_id: Column, day: Column) -> Column:
    """Key of a (store, department, day) row packed into one long: 31 bits of
    store, 16 of department, 16 of days since 1970. Unique by construction."""
    return _packed(store_id, department_id, F.datediff(day, F.lit("1970-01-01").cast("date")))


def series_key(key: Column) -> Column:
    """The (store, department) part of a sales key, the same for all versions of a store."""
    return F.shiftright(key, 16)
