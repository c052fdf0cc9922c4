"""Pre-aggregated weekly marts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwright.functions.numeric import mean_of, percent_change, quotient
from tillwright.schemas import CPI, MARKDOWNS, MONEY, TEMPERATURE, UNEMPLOYMENT
from tillwright.sources.bucketed import read_bucketed, write_bucketed

CONTEXT = ["cpi", "unemployment", "temperature"]


#: How the weekly base is kept, so that both marts read it without a shuffle.
SERIES, WEEKS, BUCKETS = ["store_id", "department_id"], ["week_start", "month_start"], 16


def keep_base(base: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write the weekly base in buckets of series and read it back; see write_bucketed."""
    return write_bucketed(base, path, SERIES, [*SERIES, *WEEKS], BUCKETS, partition_by)


def kept_base(spark: SparkSession, path: str, partition_by: str | None = None) -> DataFrame:
    return read_bucketed(spark, path, BASE_SCHEMA, SERIES, [*SERIES, *WEEKS], BUCKETS, partition_by)


def weekly_base(sales: DataFrame, features: DataFrame) -> DataFrame:
    """Sums and counts per store, department, week and month: what both marts
    share, so the join of sales and features is made once.

    Rows are laid out by (store, department) before grouping, and ``keep_base``
    keeps them so; weekly sales are unique per group already, so an earlier
    partial sum would save nothing.
    """
    context = features.select("store_id", "date", *MARKDOWNS, *CONTEXT)
    joined = sales.join(context, ["store_id", "date"], "left")
    sums = [F.sum(c).alias(f"{c}_sum") for c in [*MARKDOWNS, *CONTEXT]]
    counts = [F.count(c).alias(f"{c}_n") for c in [*MARKDOWNS, *CONTEXT]]
    return (
        joined.repartition(BUCKETS, *SERIES)
        .groupBy(
            "store_id",
            "department_id",
            F.trunc("date", "week").alias("week_start"),
            F.trunc("date", "month").alias("month_start"),
        )
        .agg(
            F.sum("weekly_sales").cast(MONEY).alias("total_sales"),
            F.count("*").alias("num_records"),
            F.max(F.col("is_holiday").cast("int")).alias("holiday"),
            *sums,
            *counts,
        )
    )


def _base_schema() -> str:
    """The columns of weekly_base: sums of decimals have ten digits more than their parts."""
    kinds = dict.fromkeys(MARKDOWNS, MONEY) | {"cpi": CPI, "unemployment": UNEMPLOYMENT, "temperature": TEMPERATURE}
    wide = {c: f"decimal({t.precision + 10},{t.scale})" for c, t in kinds.items()}
    fixed = ["store_id int", "department_id int", "week_start date", "month_start date", f"total_sales {MONEY.simpleString()}"]
    fixed += ["num_records bigint", "holiday int"]
    return ", ".join(fixed + [f"{c}_sum {t}" for c, t in wide.items()] + [f"{c}_n bigint" for c in wide])


BASE_SCHEMA = _base_schema()


def promotion_mart(base: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales, markdown averages and return per store, department and week."""
    current = stores.filter("is_current").select("store_id", "store_type", "store_size")
    spend = F.lit(0)
    for m in MARKDOWNS:
        spend = spend + F.coalesce(F.sum(f"{m}_sum"), F.lit(0))
    averages = {m: mean_of(F.sum(f"{m}_sum"), F.sum(f"{m}_n")) for m in MARKDOWNS}
    weekly = base.groupBy("store_id", "department_id", "week_start").agg(
        F.sum("total_sales").cast(MONEY).alias("total_sales"),
        mean_of(F.sum("total_sales"), F.sum("num_records")).alias("avg_sales"),
        *[F.coalesce(a, F.lit(0.0)).alias(f"avg_{m}") for m, a in averages.items()],
        *[F.coalesce(a > 0, F.lit(False)).alias(f"has_{m}") for m, a in averages.items()],
        quotient(F.sum("total_sales"), spend).alias("promotion_roi"),
        F.max("holiday").alias("has_holiday"),
    )
    return weekly.join(current, "store_id", "left").select(
        "store_id",
        "store_type",
        "store_size",
        "week_start",
        "department_id",
        "total_sales",
        "avg_sales",
        *[f"avg_{m}" for m in MARKDOWNS],
        *[f"has_{m}" for m in MARKDOWNS],
        "promotion_roi",
        "has_holiday",
    )


def trend_mart(base: DataFrame, stores: DataFrame) -> DataFrame:
    """Weekly totals with the totals 1 and 52 rows earlier and economic context."""
    series = Window.partitionBy("store_id", "department_id").orderBy("week_start", "month_start")
    current = stores.filter("is_current").select("store_id", "store_type")
    trend = base.select(
        "store_id",
        "department_id",
        "week_start",
        "month_start",
        F.trunc("month_start", "quarter").alias("quarter_start"),
        F.year("month_start").alias("year"),
        "total_sales",
        mean_of(F.col("total_sales"), F.col("num_records")).alias("avg_sales"),
        "num_records",
        F.lag("total_sales", 52).over(series).alias("sales_52w_ago"),
        F.lag("total_sales", 1).over(series).alias("sales_1w_ago"),
        *[mean_of(F.col(f"{c}_sum"), F.col(f"{c}_n")).alias(f"avg_{c}") for c in CONTEXT],
    )
    joined = trend.join(current, "store_id", "left")
    return joined.select("store_id", "store_type", *trend.columns[1:])


def trend_growth(trend: DataFrame) -> DataFrame:
    """Year-over-year and week-over-week growth in percent, two decimals."""

    def growth(before):
        return F.round(percent_change(F.col("total_sales"), F.col(before)), 2)

    return trend.select(
        "store_id",
        "department_id",
        "week_start",
        "month_start",
        "total_sales",
        growth("sales_52w_ago").alias("yoy_growth_pct"),
        growth("sales_1w_ago").alias("wow_growth_pct"),
    )
