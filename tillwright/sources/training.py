"""Where training data comes from: the clean layer or files, as the caller says.

The two give different frames (files are joined left and filled with medians),
so the choice is an argument and never depends on how many rows are there.
"""

from pyspark.sql import DataFrame, SparkSession

from tillwright import schemas
from tillwright.plans import reports
from tillwright.sources.files import read_csv
from tillwright.sources.tables import read_table, table_path

SILVER = ["silver.sales", "silver.stores", "silver.features"]
SOURCES = ("silver", "files")


def _resolve(spark, source, place, from_silver, from_files) -> DataFrame:
    if source == "silver":
        return from_silver(*[read_table(spark, table_path(place, name)) for name in SILVER])
    if source == "files":
        return from_files(
            read_csv(spark, f"{place}/train.csv", schemas.RAW_SALES),
            read_csv(spark, f"{place}/stores.csv", schemas.RAW_STORES),
            read_csv(spark, f"{place}/features.csv", schemas.RAW_FEATURES),
        )
    raise ValueError(f"source must be one of {SOURCES}, not {source!r}")


def training_source(spark: SparkSession, source: str, place: str) -> DataFrame:
    """Training frame from the clean layer (``silver``: ``place`` is the warehouse
    root) or from CSV files (``files``: their folder). A missing source raises."""
    return _resolve(spark, source, place, reports.training_frame, reports.training_frame_raw)


def promotion_source(spark: SparkSession, source: str, place: str) -> DataFrame:
    """Promotion frame, resolved like training_source."""
    return _resolve(spark, source, place, reports.promotion_frame, reports.promotion_frame_raw)
