"""The raw-to-clean step as a stream: each new raw file is cleaned and merged."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.plans import silver
from tillwright.plans.build import MONTH, Warehouse
from tillwright.sources.tables import drop_staged, merge_table, staged_count


def stream_sales(
    spark: SparkSession, warehouse: Warehouse, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Follow ``bronze.sales`` and keep ``silver.sales`` merged.

    Every row counts, whatever day it was loaded on. Rows are stamped with their
    load time, and the latest load of a key wins, in whichever order files come;
    of one load time, the highest amount. The merge gives the same result when a
    batch is replayed after a failure.
    """
    source = warehouse.path("bronze.sales")
    raw = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        others = staged_count()
        try:
            merge_table(
                batch.sparkSession,
                warehouse.path("silver.sales"),
                silver.loaded_sales(batch).withColumn(MONTH, F.trunc("date", "month")),
                ["store_id", "department_id", "date"],
                silver.SALES_VALUES,
                touch_cols=["updated_at"],
                partition_by=MONTH,
                newer_by=["updated_at", *silver.SALES_VALUES],
            )
        finally:
            drop_staged(batch.sparkSession, keep=others)

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
