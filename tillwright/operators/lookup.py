"""Dimension lookups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_of_dimension(
    fact: DataFrame, dim: DataFrame, key: str, day: str, how: str = "inner"
) -> DataFrame:
    """Each fact row with the dimension version valid on ``day``. A row without
    one is left out, or with ``how="left"`` kept with NULLs.

    Equality on ``key`` drives the join; the date range only filters the few
    versions of one key.
    """
    versions = dim.withColumnRenamed(key, "_dim_key")
    valid = F.col(day).between(F.col("effective_date"), F.col("end_date"))
    return fact.join(versions, (F.col(key) == F.col("_dim_key")) & valid, how).drop("_dim_key")
