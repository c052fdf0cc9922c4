"""Parquet tables bucketed by key columns: what is grouped or windowed by the keys needs no shuffle.

Buckets are known to the catalog alone, so a table is declared in the session's
catalog whenever it is read, over the folder it was written to.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession

from tillwright.sources.tables import COMPRESSION, _names


def _declared(spark: SparkSession, path: str, schema: str, keys, order, buckets: int, partition_by: str | None) -> str:
    """The name of the table over ``path``, declared if the session doesn't know it."""
    name = f"bucketed_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        order = [c for c in order if c != partition_by]  # one value in a file
        part = f"PARTITIONED BY ({partition_by})" if partition_by else ""
        spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (compression '{COMPRESSION}') {part} CLUSTERED BY ({', '.join(keys)}) "
            f"SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return name


def write_bucketed(df: DataFrame, path: str, keys, order, buckets: int, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to ``path`` and read it back; with ``partition_by``, only the partitions
    in ``df`` are replaced. A write cut short must be repeated: there is no version to go
    back to, so such a table only holds what can be derived again."""
    spark = df.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    name = _declared(spark, path, schema, keys, order, buckets, partition_by)
    columns = spark.table(name).columns  # a partition's column comes last
    # Each bucket in one task, so that a partition has one file a bucket.
    rows = df.repartition(buckets, *keys).select(*columns)
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic" if partition_by else "static")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(key, before)
    spark.catalog.refreshTable(name)
    return spark.table(name).select(*df.columns)


def read_bucketed(spark: SparkSession, path: str, schema: str, keys, order, buckets: int, partition_by: str | None = None) -> DataFrame:
    return spark.table(_declared(spark, path, schema, keys, order, buckets, partition_by))


def is_written(spark: SparkSession, path: str) -> bool:
    return "_SUCCESS" in _names(spark, path)
