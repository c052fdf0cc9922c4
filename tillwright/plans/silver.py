"""Raw to clean: typing, validity rules, latest record per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.numeric import nan_to_null, or_zero
from tillwright.operators.keys import sales_key, store_version_key
from tillwright.operators.latest import latest_per_key
from tillwright.operators.scd2 import scd2_apply
from tillwright.schemas import CPI, FUEL, MARKDOWNS, MONEY, TEMPERATURE, UNEMPLOYMENT

LOOKBACK_DAYS = 1
STORE_TRACKED = ["store_type", "store_size"]
FEATURE_VALUES = ["temperature", "fuel_price", *MARKDOWNS, "cpi", "unemployment", "is_holiday"]
SALES_VALUES = ["weekly_sales", "is_holiday"]
STAMPS = ["created_at", "updated_at"]


def recent(bronze: DataFrame, as_of, days: int = LOOKBACK_DAYS, due=()) -> DataFrame:
    """Rows loaded on ``as_of`` or in the ``days`` before it, or on one of the days ``due``.

    Later loads are left out, so a past day can be run again. On a table
    partitioned by load day the filter on that column prunes partitions.
    """
    day = F.lit(as_of).cast("date")
    since, until = F.date_sub(day, days), F.date_add(day, 1)
    missed = [F.lit(d).cast("date") for d in due]
    loaded = F.col("ingestion_timestamp")
    recently = loaded >= since.cast("timestamp")
    if missed:
        recently = recently | F.to_date(loaded).isin(*missed)
    rows = bronze.filter(recently & (loaded < until.cast("timestamp")))
    if "ingest_date" in bronze.columns:
        in_window = F.col("ingest_date").between(since, day)
        rows = rows.filter(in_window | F.col("ingest_date").isin(*missed) if missed else in_window)
    return rows


def _stamp(as_of):
    return F.lit(as_of).cast("date").cast("timestamp")


def store_snapshot(bronze: DataFrame, as_of) -> DataFrame:
    """Valid store rows of the latest loads, one per store."""
    valid = recent(bronze, as_of).filter(F.col("type").isin("A", "B", "C") & (F.col("size") > 0))
    newest = [F.desc("ingestion_timestamp"), F.asc("type"), F.desc("size")]
    return latest_per_key(valid, ["store"], newest).select(
        F.col("store").alias("store_id"),
        F.col("type").alias("store_type"),
        F.col("size").alias("store_size"),
    )


def no_stores(spark) -> DataFrame:
    """An empty store history."""
    return spark.createDataFrame(
        [],
        "store_id int, store_type string, store_size int, effective_date date,"
        " end_date date, is_current boolean, version int",
    )


def silver_stores(bronze: DataFrame, current: DataFrame | None, as_of) -> DataFrame:
    """Store history after the loads of ``as_of`` (type 2 versions).

    ``current`` is the history so far, or None.
    """
    history = no_stores(bronze.sparkSession) if current is None else current
    history = history.select(
        "store_id", *STORE_TRACKED, "effective_date", "end_date", "is_current", "version"
    )
    versions = scd2_apply(history, store_snapshot(bronze, as_of), "store_id", STORE_TRACKED, as_of)
    return versions.select(
        store_version_key(F.col("store_id"), F.col("version")).alias("store_key"), "*"
    )


def silver_features(bronze: DataFrame, as_of, due=()) -> DataFrame:
    """Clean weekly features of the loads of ``as_of``, and of the days ``due``: one row
    per store and date.

    Rows need cpi > 0 and 0 <= unemployment <= 100; NULL and NaN fail (NaN
    compares above every number, so an upper bound rejects it, and cpi has
    none). A negative or missing fuel price becomes 0, a missing markdown 0.
    """
    valid = recent(bronze, as_of, due=due).filter(
        (F.col("cpi") > 0)
        & ~F.isnan("cpi")
        & (F.col("unemployment") >= 0)
        & (F.col("unemployment") <= 100)
    )
    clean = valid.select(
        F.col("store").alias("store_id"),
        F.col("date").cast("date").alias("date"),
        nan_to_null(F.col("temperature")).cast(TEMPERATURE).alias("temperature"),
        F.greatest(nan_to_null(F.col("fuel_price")), F.lit(0.0)).cast(FUEL).alias("fuel_price"),
        *[or_zero(F.col(m)).cast(MONEY).alias(m) for m in MARKDOWNS],
        nan_to_null(F.col("cpi")).cast(CPI).alias("cpi"),
        F.col("unemployment").cast(UNEMPLOYMENT).alias("unemployment"),
        F.col("isholiday").alias("is_holiday"),
        "ingestion_timestamp",
    )
    newest = [F.desc("ingestion_timestamp"), *[F.desc(c) for c in FEATURE_VALUES]]
    latest = latest_per_key(clean, ["store_id", "date"], newest)
    return latest.select(
        "store_id",
        "date",
        *FEATURE_VALUES,
        _stamp(as_of).alias("created_at"),
        _stamp(as_of).alias("updated_at"),
    )


def silver_sales(bronze: DataFrame, as_of, due=()) -> DataFrame:
    """Clean weekly sales of the loads of ``as_of``, and of the days ``due``: one row per store,
    department and date. Negative amounts (returns) stay; of several rows of
    one load time the highest amount wins."""
    return _clean_sales(recent(bronze, as_of, due=due), _stamp(as_of))


def loaded_sales(bronze: DataFrame) -> DataFrame:
    """Clean weekly sales of all rows of ``bronze``, stamped with their load time."""
    return _clean_sales(bronze, F.col("ingestion_timestamp"))


def _clean_sales(loads: DataFrame, stamp) -> DataFrame:
    valid = loads.filter(F.col("weekly_sales").isNotNull())
    clean = valid.select(
        F.col("store").alias("store_id"),
        F.col("dept").alias("department_id"),
        F.col("date").cast("date").alias("date"),
        F.col("weekly_sales").cast(MONEY).alias("weekly_sales"),
        F.col("isholiday").alias("is_holiday"),
        "ingestion_timestamp",
    )
    newest = [F.desc("ingestion_timestamp"), F.desc("weekly_sales"), F.desc("is_holiday")]
    latest = latest_per_key(clean, ["store_id", "department_id", "date"], newest)
    return latest.select(
        sales_key(F.col("store_id"), F.col("department_id"), F.col("date")).alias("sales_id"),
        "store_id",
        "department_id",
        "date",
        *SALES_VALUES,
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def current_stores(stores: DataFrame) -> DataFrame:
    return stores.filter("is_current")
