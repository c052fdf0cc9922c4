"""Slowly changing dimension, type 2: every version of a row is kept."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

OPEN_END = "9999-12-31"


def _open_end():
    return F.lit(OPEN_END).cast("date")


def scd2_apply(current: DataFrame, snapshot: DataFrame, key: str, tracked, as_of) -> DataFrame:
    """All versions after ``snapshot`` is seen on ``as_of``.

    ``snapshot`` has ``key`` and the ``tracked`` columns, one row per key.
    A changed key closes its current version on the day before and opens the
    next one; a second change on the same day corrects the version opened that
    day. Keys missing from the snapshot stay as they are.
    """
    day = F.lit(as_of).cast("date")
    closed = current.filter(~F.col("is_current"))
    seen = snapshot.select(
        key, *[F.col(c).alias(f"_new_{c}") for c in tracked], F.lit(True).alias("_seen")
    )
    pairs = current.filter("is_current").join(seen, key, "full_outer")

    differs = F.lit(False)
    for column in tracked:
        differs = differs | ~F.col(column).eqNullSafe(F.col(f"_new_{column}"))
    is_new = F.col("version").isNull()
    changed = F.col("_seen").isNotNull() & differs & ~is_new
    same_day = F.col("effective_date") == day
    splits = changed & ~same_day

    others = [c for c in current.columns if c != key and c not in tracked]
    shape = [key, *tracked, *others]

    def row(values):
        return F.struct(*[values.get(c, F.col(c)).alias(c) for c in shape])

    kept = row(
        {
            "end_date": F.when(splits, F.date_sub(day, 1)).otherwise(F.col("end_date")),
            "is_current": F.col("is_current") & ~splits,
            **{
                c: F.when(changed & same_day, F.col(f"_new_{c}")).otherwise(F.col(c))
                for c in tracked
            },
        }
    )
    opened = row(
        {
            **{c: F.col(f"_new_{c}") for c in tracked},
            "effective_date": day,
            "end_date": _open_end(),
            "is_current": F.lit(True),
            "version": F.coalesce(F.col("version"), F.lit(0)) + 1,
        }
    )
    versions = F.when(is_new, F.array(opened)).when(splits, F.array(kept, opened)).otherwise(
        F.array(kept)
    )
    fresh = pairs.select(F.inline(versions)).select(*current.columns)
    return closed.unionByName(fresh)


def scd2_from_history(snapshots: DataFrame, key: str, tracked, day: str) -> DataFrame:
    """Build all versions from dated snapshots (``key``, ``tracked``, ``day``).

    One row per key and day is expected. The window holds the snapshots of one
    key, at most one a day.
    """
    by_key = Window.partitionBy(key).orderBy(day)
    state = F.struct(*tracked)
    opens = (
        snapshots.withColumn("_before", F.lag(state).over(by_key))
        .withColumn("_first", F.row_number().over(by_key) == 1)
        .filter(F.col("_first") | ~F.col("_before").eqNullSafe(state))
    )
    following = F.lead(day).over(by_key)
    return opens.select(
        key,
        *tracked,
        F.col(day).alias("effective_date"),
        F.coalesce(F.date_sub(following, 1), _open_end()).alias("end_date"),
        following.isNull().alias("is_current"),
        F.row_number().over(by_key).alias("version"),
    )
