"""Declared schemas. Nothing in the package infers a type.

Amounts are ``decimal(18,2)``: wider than a weekly store/department amount
needs, so that sums over a very large or very skewed week cannot overflow
(ANSI mode turns an overflow into a failed job).
"""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 2)
TEMPERATURE = DecimalType(5, 2)
FUEL = DecimalType(5, 3)
CPI = DecimalType(10, 6)
# Three whole digits: 100 is a valid rate.
UNEMPLOYMENT = DecimalType(6, 3)
PERCENT = DecimalType(5, 2)
# Sums over whole tables; narrow enough that a quotient of two keeps 14 decimals.
TOTAL = DecimalType(24, 2)

MARKDOWNS = ["markdown1", "markdown2", "markdown3", "markdown4", "markdown5"]
INDICATORS = ["temperature", "fuel_price", "cpi", "unemployment"]


def _struct(*fields):
    return StructType([StructField(name, kind) for name, kind in fields])


# Source files, in file column order.
RAW_STORES = _struct(("store", IntegerType()), ("type", StringType()), ("size", IntegerType()))

RAW_FEATURES = _struct(
    ("store", IntegerType()),
    ("date", DateType()),
    ("temperature", DoubleType()),
    ("fuel_price", DoubleType()),
    *[(m, DoubleType()) for m in MARKDOWNS],
    ("cpi", DoubleType()),
    ("unemployment", DoubleType()),
    ("isholiday", BooleanType()),
)

RAW_SALES = _struct(
    ("store", IntegerType()),
    ("dept", IntegerType()),
    ("date", DateType()),
    ("weekly_sales", DoubleType()),
    ("isholiday", BooleanType()),
)

AUDIT = _struct(
    ("ingestion_timestamp", TimestampType()),
    ("source_file", StringType()),
    ("row_hash", StringType()),
)

FORECAST_REQUESTS = _struct(
    ("store_id", IntegerType()),
    ("department_id", IntegerType()),
    ("date", DateType()),
    ("temperature", DoubleType()),
    ("fuel_price", DoubleType()),
    *[(m, DoubleType()) for m in MARKDOWNS],
    ("cpi", DoubleType()),
    ("unemployment", DoubleType()),
    ("is_holiday", BooleanType()),
)

ALLOCATION_REQUESTS = _struct(
    ("store_id", IntegerType()),
    ("department_id", IntegerType()),
    ("budget", DoubleType()),
    ("is_holiday", BooleanType()),
)

# Uniqueness each table must keep.
TABLE_KEYS = {
    "silver.stores": [["store_id", "version"], ["store_id", "effective_date"]],
    "silver.features": [["store_id", "date"]],
    "silver.sales": [["store_id", "department_id", "date"]],
    "platinum.promotion": [["store_id", "department_id", "week_start"]],
    "platinum.trend": [["store_id", "department_id", "week_start"]],
    "gold.dim_date": [["date_key"], ["full_date"]],
    "gold.dim_store": [["store_id", "version"]],
    "gold.dim_department": [["department_id"]],
    "gold.dim_promotion": [MARKDOWNS],
    "gold.dim_economic": [INDICATORS],
    "gold.fact_sales": [["date_key", "store_key", "department_key"]],
}
