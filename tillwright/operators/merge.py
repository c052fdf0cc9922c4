"""Keyed upsert and insert-if-absent."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, batch: DataFrame, keys, update_cols, touch_cols=(), newer_by=()
) -> DataFrame:
    """Insert unseen keys; overwrite ``update_cols`` and ``touch_cols`` of seen ones.

    Both sides must be unique on ``keys``. Other target columns of a seen row
    stay, even where the new value of an updated column is NULL. A row whose
    ``update_cols`` all equal the stored ones is left alone, so applying the
    same batch twice changes nothing, ``touch_cols`` (load stamps) included.

    With ``newer_by`` the greater of the two rows in these columns wins instead,
    whichever comes first, so batches may arrive in any order. They should start
    with the load time and go on with what decides between rows of one load.
    """
    seen = batch.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in batch.columns if c not in keys],
        F.lit(True).alias("_in_batch"),
    )
    stored = target.withColumn("_in_target", F.lit(True))
    changed = F.lit(False)
    for column in update_cols:
        changed = changed | ~F.col(column).eqNullSafe(F.col(f"_new_{column}"))
    inserted = F.col("_in_target").isNull()
    if newer_by:
        new_order = F.struct(*[F.col(f"_new_{c}").alias(c) for c in newer_by])
        changed = new_order > F.struct(*newer_by)
    overwritten = F.col("_in_batch").isNotNull() & changed

    def value(column):
        if column in keys:
            return F.col(column)
        if column not in batch.columns:
            return F.col(column)
        new = F.col(f"_new_{column}")
        takes_new = inserted
        if column in update_cols or column in touch_cols:
            takes_new = inserted | overwritten
        return F.when(takes_new, new).otherwise(F.col(column)).alias(column)

    return stored.join(seen, list(keys), "full_outer").select(*[value(c) for c in target.columns])


def absent(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``."""
    return batch.join(target.select(*keys), list(keys), "left_anti")


def insert_absent(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """``target`` plus the rows of ``batch`` with an unseen key."""
    return target.unionByName(absent(target, batch, keys), allowMissingColumns=True)
