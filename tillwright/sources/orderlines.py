"""Retail-week inputs derived from an order-lines table.

The warehouse needs weekly store/department sales, weekly store features and
store snapshots. This adapter derives them from ``lineitem`` with plain column
formulas, so that every query can run over tables of any scale: the supplier
is the store, ten part groups are the departments, and the shipping week is
the sales week. Stores, and with them all derived tables, grow with the input.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions.dates import in_holiday_window
from tillwright.schemas import MARKDOWNS, MONEY
from tillwright.sources.files import with_audit

# The two load days of the derived raw layer.
LOAD1 = "2010-02-05"
LOAD2 = "2011-07-01"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("l_shipdate")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_suppkey") + 1).cast("int").alias("store"),
        (F.col("l_partkey") % 10 * 10 + 5).cast("int").alias("dept"),
        F.date_add(F.trunc(day, "week"), 4).alias("date"),
        "l_linenumber",
        "l_returnflag",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("ep"),
        F.col("l_discount").cast("decimal(4,2)").alias("di"),
    )


def _week(day: Column) -> Column:
    return (F.datediff(day, F.lit("1995-01-06").cast("date")) / 7).cast("long")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store, dept, date, weekly_sales, isholiday; returns count as negative."""
    amount = F.col("ep") * (1 - F.col("di"))
    signed = F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount)
    return (
        lines(spark, sf_dir)
        .groupBy("store", "dept", "date")
        .agg(F.sum(signed).cast(MONEY).cast("double").alias("weekly_sales"))
        .withColumn("isholiday", in_holiday_window(F.col("date")))
    )


def raw_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per store and week, with missing and out-of-range values mixed in."""
    spend = F.col("ep") * F.col("di")
    sums = [
        F.sum(F.when((F.col("l_linenumber") == k) & (F.col("di") > 0.05), spend))
        .cast(MONEY)
        .cast("double")
        .alias(name)
        for k, name in enumerate(MARKDOWNS, 1)
    ]
    s, w = F.col("store").cast("long"), _week(F.col("date"))
    nan = F.lit(float("nan"))
    fuel = 2 + 0.005 * ((s + 3 * w) % 500)
    weekly = lines(spark, sf_dir).groupBy("store", "date").agg(*sums)
    return weekly.select(
        "store",
        "date",
        F.when((s + 5 * w) % 223 != 0, 20 + 0.05 * ((7 * s + 13 * w) % 1600)).alias("temperature"),
        F.when((s + 7 * w) % 227 != 0, F.when((31 * s + w) % 97 == 0, -fuel).otherwise(fuel)).alias(
            "fuel_price"
        ),
        *[F.coalesce(F.col(m), F.when(s % 2 == 0, nan)).alias(m) for m in MARKDOWNS],
        F.when((s + w) % 211 == 0, 0.0)
        .when((s + 11 * w) % 313 == 0, nan)
        .otherwise(180 + 0.0625 * ((11 * s + w) % 800))
        .alias("cpi"),
        F.when((3 * s + w) % 307 == 0, nan)
        .otherwise(3.5 + 0.025 * ((5 * s + w) % 300))
        .alias("unemployment"),
        in_holiday_window(F.col("date")).alias("isholiday"),
    )


def raw_stores(sales: DataFrame, snapshot: int = 1) -> DataFrame:
    """Master data of the stores in ``sales``; in snapshot 2 some stores have
    grown or changed type."""
    s = F.col("store")
    kind = s % 3
    size = 30000 + 4300 * (s % 45)
    if snapshot == 2:
        kind = F.when(s % 7 == 0, kind + 1).otherwise(kind) % 3
        size = size + F.when(s % 5 == 0, 10000).otherwise(0)
    letter = F.when(kind == 0, "A").when(kind == 1, "B").otherwise("C")
    stores = sales.select("store").distinct()
    return stores.select("store", letter.alias("type"), size.alias("size"))


def _copies(rules) -> Column:
    """Array of copy numbers: 0 always, n where its condition holds."""
    chosen = [F.lit(0)] + [F.when(condition, n) for n, condition in rules]
    return F.filter(F.array(*chosen), lambda n: n.isNotNull())


def _stamp(day: str, time: str) -> Column:
    return F.lit(f"{day} {time}").cast("timestamp")


def bronze_stores(stores1: DataFrame, stores2: DataFrame) -> DataFrame:
    """Both snapshots, the second with rejected rows (bad type, zero size)."""
    bad = F.explode(_copies([(1, F.col("store") % 20 == 0), (2, F.col("store") % 30 == 0)]))
    second = stores2.select("*", bad.alias("copy")).select(
        "store",
        F.when(F.col("copy") == 1, "Z").otherwise(F.col("type")).alias("type"),
        F.when(F.col("copy") == 2, 0).otherwise(F.col("size")).alias("size"),
    )
    return with_audit(stores1, "stores.csv", _stamp(LOAD1, "01:00:00")).unionByName(
        with_audit(second, "stores.csv", _stamp(LOAD2, "01:00:00"))
    )


def bronze_features(features: DataFrame) -> DataFrame:
    """Raw rows plus corrections of the same load and rows of an older load."""
    h = F.col("store").cast("long") + _week(F.col("date"))
    copy = F.col("copy")
    copies = features.select("*", F.explode(_copies([(1, h % 11 == 0), (3, h % 7 == 0)])).alias("copy"))
    shift = F.when(copy == 1, 1.0).when(copy == 3, -1.0).otherwise(0.0)
    stamp = (
        F.when(copy == 1, _stamp(LOAD2, "01:05:00"))
        .when(copy == 3, _stamp(LOAD1, "01:00:00"))
        .otherwise(_stamp(LOAD2, "01:00:00"))
    )
    shifted = copies.withColumns({"temperature": F.col("temperature") + shift, "_stamp": stamp})
    return with_audit(shifted.select(*features.columns, "_stamp"), "features.csv", F.col("_stamp"))


def bronze_sales(sales: DataFrame) -> DataFrame:
    """Raw rows plus corrections, NULL amounts, ties and rows of an older load."""
    h = F.col("store").cast("long") * 7 + F.col("dept") * 3 + _week(F.col("date"))
    copy = F.col("copy")
    rules = [(1, h % 13 == 0), (2, h % 17 == 0), (3, h % 5 == 0), (4, h % 19 == 0)]
    copies = sales.select("*", F.explode(_copies(rules)).alias("copy"))
    shift = F.when(copy == 1, 10.0).when(copy == 3, -5.0).when(copy == 4, 1.0).otherwise(0.0)
    amount = F.when(copy != 2, F.round(F.col("weekly_sales") + shift, 2))
    stamp = (
        F.when(copy == 1, _stamp(LOAD2, "01:05:00"))
        .when(copy == 2, _stamp(LOAD2, "01:10:00"))
        .when(copy == 3, _stamp(LOAD1, "01:00:00"))
        .otherwise(_stamp(LOAD2, "01:00:00"))
    )
    shifted = copies.withColumns({"weekly_sales": amount, "_stamp": stamp})
    return with_audit(shifted.select(*sales.columns, "_stamp"), "train.csv", F.col("_stamp"))
