"""Star schema: five dimensions, the sales fact, year-over-year, views."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwright.functions import bands
from tillwright.functions.bands import band
from tillwright.functions.dates import date_key, with_calendar, with_holidays
from tillwright.functions.numeric import (
    active_markdowns,
    markdown_total,
    mean_of,
    percent_change,
    quotient,
    ratio,
)
from tillwright.operators.keys import extend_keys, global_rank, series_key
from tillwright.operators.merge import absent, insert_absent
from tillwright.schemas import (
    CPI,
    FUEL,
    INDICATORS,
    MARKDOWNS,
    MONEY,
    PERCENT,
    TEMPERATURE,
    UNEMPLOYMENT,
)

FACT_LOOKBACK_DAYS = 2
FACT_UPDATES = [
    "store_key",
    "promotion_key",
    "economic_key",
    "is_holiday",
    "weekly_sales",
]
ZERO_SPREAD = 1024


# --- calendar ---------------------------------------------------------------


def dim_date_from_facts(
    sales: DataFrame, features: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Calendar rows of all dates seen in sales or features.

    With ``existing``, its rows are kept and only unseen dates are added.
    """
    days = sales.select("date").union(features.select("date")).distinct()
    calendar = with_calendar(days.withColumnRenamed("date", "full_date"))
    if existing is not None:
        calendar = insert_absent(existing, calendar, ["full_date"])
    return with_holidays(calendar)


def dim_date_range(spark: SparkSession, start, end) -> DataFrame:
    """A gapless daily calendar from ``start`` to ``end``."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """A gapless daily calendar over the one row (first_day, last_day)."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    return with_holidays(with_calendar(days))


# --- store and department -----------------------------------------------------


def store_efficiency(silver_stores: DataFrame, sales: DataFrame) -> DataFrame:
    """store_key, sales_per_sqft_avg, store_efficiency_rank of the current versions with sales.

    The average weekly sales of a store over its square feet, two decimals; the
    highest ranks first, and equal ones share a rank. Sales are summed by store and
    week before the weeks are counted.
    """
    weekly = sales.groupBy("store_id", "date").agg(F.sum("weekly_sales").alias("amount"))
    totals = weekly.groupBy("store_id").agg(F.sum("amount").cast(MONEY).alias("total"), F.count("*").alias("weeks"))
    current = silver_stores.filter("is_current").select("store_key", "store_id", "store_size")
    per_foot = F.round(ratio(F.col("total"), F.col("weeks") * F.col("store_size")), 2).cast("decimal(10,2)")
    measured = current.join(totals, "store_id").select("store_key", per_foot.alias("sales_per_sqft_avg"))
    ranked = global_rank(measured, "sales_per_sqft_avg", "store_efficiency_rank")
    return ranked.withColumn("store_efficiency_rank", F.col("store_efficiency_rank").cast("int"))


def dim_store(silver_stores: DataFrame, efficiency: DataFrame | None = None) -> DataFrame:
    """Every store version with its descriptions; ``efficiency``: see store_efficiency.

    Keys are computed from (store_id, version), so rebuilding from the silver
    history inserts new versions and carries closed ones, without renumbering.
    """
    size = F.col("store_size")
    unset = F.lit(None)
    measured, rank = unset.cast("decimal(10,2)"), unset.cast("int")
    if efficiency is not None:
        silver_stores = silver_stores.join(efficiency, "store_key", "left")
        measured, rank = F.col("sales_per_sqft_avg"), F.col("store_efficiency_rank")
    return silver_stores.select(
        "store_key",
        "store_id",
        "store_type",
        bands.store_type_name(F.col("store_type")).alias("store_type_description"),
        "store_size",
        band(size, *bands.SIZE_BANDS).alias("size_category"),
        *[unset.cast("string").alias(c) for c in ("region", "state", "city")],
        measured.alias("sales_per_sqft_avg"),
        rank.alias("store_efficiency_rank"),
        "effective_date",
        "end_date",
        "is_current",
        "version",
    )


def _departments(ids: DataFrame, category, group, division) -> DataFrame:
    d = F.col("department_id")
    return ids.select(
        d.alias("department_key"),
        d.alias("department_id"),
        F.concat(F.lit("Department "), d.cast("string")).alias("department_name"),
        category.alias("department_category"),
        group.alias("department_group"),
        division.alias("division"),
        category.isin(bands.SEASONAL_CATEGORIES).alias("is_seasonal"),
        F.lit(False).alias("is_high_margin"),
        F.lit(None).cast(PERCENT).alias("avg_margin_pct"),
    )


def dim_department(sales: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per department seen in sales; ``existing`` rows are kept."""
    d = F.col("department_id")
    found = _departments(
        sales.select("department_id").distinct(),
        band(d, *bands.DEPARTMENT_CATEGORIES, right_closed=True),
        band(d, *bands.DEPARTMENT_GROUPS, right_closed=True),
        band(d, *bands.DEPARTMENT_DIVISIONS, right_closed=True),
    )
    return found if existing is None else insert_absent(existing, found, ["department_id"])


def dim_department_default(spark: SparkSession, last: int = 99) -> DataFrame:
    """The pre-populated departments 1 … ``last``, with their coarser map."""
    ids = spark.range(1, last + 1).select(F.col("id").cast("int").alias("department_id"))
    d = F.col("department_id")
    return _departments(
        ids,
        band(d, *bands.DEFAULT_CATEGORIES, right_closed=True),
        band(d, *bands.DEFAULT_GROUPS, right_closed=True),
        F.lit(None).cast("string"),
    )


# --- promotion and economic dimensions ----------------------------------------


def _promotion_tuple() -> dict:
    return {m: F.coalesce(F.round(F.col(m), 2), F.lit(0)).cast(MONEY) for m in MARKDOWNS}


def _economic_tuple() -> dict:
    def rounded(column, default, digits, kind):
        return F.round(F.coalesce(F.col(column), F.lit(default)), digits).cast(kind)

    return {
        "temperature": rounded("temperature", 0, 1, TEMPERATURE),
        "fuel_price": rounded("fuel_price", 0, 2, FUEL),
        "cpi": rounded("cpi", 1, 3, CPI),
        "unemployment": rounded("unemployment", 0, 2, UNEMPLOYMENT),
    }


def _one_row(spark: SparkSession, values: dict) -> DataFrame:
    return spark.range(1).select(*[value.alias(name) for name, value in values.items()])


def _promotion_columns(tuples: DataFrame) -> DataFrame:
    total, active = markdown_total().cast(MONEY), active_markdowns()
    return tuples.select(
        "promotion_key",
        *MARKDOWNS,
        total.alias("total_markdown"),
        *[(F.col(m) > 0).alias(f"has_{m}") for m in MARKDOWNS],
        active.alias("num_markdowns"),
        bands.promotion_type(markdown_total()).alias("promotion_type"),
        bands.promotion_intensity(active).alias("promotion_intensity"),
    )


def no_promotion(spark: SparkSession) -> DataFrame:
    """The row of key 0: the tuple of zeros."""
    zero = {m: F.lit(0).cast(MONEY) for m in MARKDOWNS}
    return _promotion_columns(_one_row(spark, {"promotion_key": F.lit(0).cast("long"), **zero}))


def new_promotions(features: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows for the markdown tuples not in ``existing``, keyed after its highest key."""
    tuples = features.select(*[c.alias(m) for m, c in _promotion_tuple().items()]).distinct()
    fresh = absent(existing, tuples, MARKDOWNS)
    return _promotion_columns(extend_keys(existing, fresh, MARKDOWNS, "promotion_key"))


def dim_promotion(features: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct markdown tuples; key 0 is the tuple of zeros ("no promotion")."""
    known = no_promotion(features.sparkSession) if existing is None else existing
    return known.unionByName(new_promotions(features, known))


def _economic_columns(tuples: DataFrame) -> DataFrame:
    t, f, c, u = (F.col(name) for name in INDICATORS)
    return tuples.select(
        "economic_key",
        t.alias("temperature"),
        band(t, *bands.TEMPERATURE_BANDS).alias("temperature_band"),
        f.alias("fuel_price"),
        band(f, *bands.FUEL_BANDS).alias("fuel_price_band"),
        c.alias("cpi"),
        band(c, *bands.CPI_BANDS).alias("cpi_category"),
        u.alias("unemployment"),
        band(u, *bands.UNEMPLOYMENT_BANDS).alias("unemployment_category"),
        band(u, *bands.CONDITION_BANDS).alias("economic_condition"),
    )


def unknown_economics(spark: SparkSession) -> DataFrame:
    """The row of key 0, for sales without features."""
    values = {
        "economic_key": F.lit(0).cast("long"),
        "temperature": F.lit(0).cast(TEMPERATURE),
        "fuel_price": F.lit(0).cast(FUEL),
        "cpi": F.lit(1).cast(CPI),
        "unemployment": F.lit(0).cast(UNEMPLOYMENT),
    }
    labels = ["temperature_band", "fuel_price_band", "cpi_category", "unemployment_category"]
    return _economic_columns(_one_row(spark, values)).withColumns(
        {
            **{label: F.lit(None).cast("string") for label in labels},
            "economic_condition": F.lit("Unknown"),
        }
    )


def new_economics(features: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows for the rounded indicator tuples not in ``existing``, keyed after it."""
    tuples = features.select(*[c.alias(n) for n, c in _economic_tuple().items()]).distinct()
    fresh = absent(existing, tuples, INDICATORS)
    return _economic_columns(extend_keys(existing, fresh, INDICATORS, "economic_key"))


def dim_economic(features: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct rounded indicator tuples with their bands; key 0 is "Unknown".

    Bands are computed from the rounded values, so one key has one set of bands.
    """
    known = unknown_economics(features.sparkSession) if existing is None else existing
    return known.unionByName(new_economics(features, known))


def feature_keys(features: DataFrame, promotions: DataFrame, economics: DataFrame) -> DataFrame:
    """store_id, date, promotion_key, economic_key of each feature row.

    Resolving the two wide keys here, at one row per store and date, keeps
    them away from the far larger sales rows. Rows of zeros, usually the bulk,
    have key 0 by definition: a spread column sends them to many partitions,
    where they match nothing, instead of all to the one of the zero tuple.
    """
    zero = reduce(and_, [c == 0 for c in _promotion_tuple().values()])
    spread = F.when(zero, F.pmod(F.xxhash64("store_id", "date"), F.lit(ZERO_SPREAD)) + 1).otherwise(0)
    wide = features.select(
        "store_id",
        "date",
        spread.cast("long").alias("_spread"),
        *[c.alias(f"_{n}") for n, c in _promotion_tuple().items()],
        *[c.alias(f"_{n}") for n, c in _economic_tuple().items()],
    )
    p = promotions.select("promotion_key", *MARKDOWNS, F.lit(0).cast("long").alias("_no_spread"))
    same_tuple = [F.col(f"_{m}") == F.col(m) for m in MARKDOWNS]
    same_tuple.append(F.col("_spread") == F.col("_no_spread"))
    keyed = wide.join(p, reduce(and_, same_tuple), "left")
    e = economics.select("economic_key", *INDICATORS)
    same_levels = [F.col(f"_{n}") == F.col(n) for n in INDICATORS]
    return keyed.join(e, reduce(and_, same_levels), "left").select(
        "store_id",
        "date",
        F.coalesce("promotion_key", F.lit(0)).alias("promotion_key"),
        F.coalesce("economic_key", F.lit(0)).alias("economic_key"),
    )


# --- fact -----------------------------------------------------------------------


def changed_since(sales: DataFrame, as_of, days: int = FACT_LOOKBACK_DAYS) -> DataFrame:
    """Silver rows inserted or corrected in the last ``days`` days."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return sales.filter(F.col("updated_at") >= since.cast("timestamp"))


def changed_with_features(
    sales: DataFrame, features: DataFrame, as_of, days: int = FACT_LOOKBACK_DAYS
) -> DataFrame:
    """Silver rows changed in the last ``days`` days, or whose week's features
    were; such a row is stamped with the features' change. Columns that both
    sides share beyond store and date, such as a partition's, join them too."""
    fresh = changed_since(sales, as_of, days)
    corrected = changed_since(features, as_of, days)
    on = ["store_id", "date"] + [c for c in ("month_start",) if c in sales.columns and c in features.columns]
    weeks = corrected.select(*on, F.col("updated_at").alias("_corrected"))
    since = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp")
    others = sales.filter(~(F.col("updated_at") >= since)).join(weeks, on)
    stamped = others.withColumn("updated_at", F.col("_corrected"))
    return fresh.unionByName(stamped.select(*sales.columns))


def fact_sales(
    sales: DataFrame,
    dates: DataFrame,
    stores: DataFrame,
    departments: DataFrame,
    keys: DataFrame,
) -> DataFrame:
    """Sales rows with their dimension keys; ``keys`` comes from feature_keys.

    A sale without features gets promotion and economic key 0. ``sales_key``
    identifies (store, department, date) across store versions.
    """
    versions = stores.filter("is_current").select("store_id", "store_key")
    return (
        sales.join(dates.select(F.col("full_date").alias("date"), "date_key"), "date")
        .join(departments.select("department_id", "department_key"), "department_id")
        .join(versions, "store_id")
        .join(keys, ["store_id", "date"], "left")
        .select(
            F.col("sales_id").alias("sales_key"),
            "date_key",
            "store_key",
            "department_key",
            F.coalesce("promotion_key", F.lit(0)).alias("promotion_key"),
            F.coalesce("economic_key", F.lit(0)).alias("economic_key"),
            "is_holiday",
            "weekly_sales",
            F.lit(0).alias("sales_quantity"),
            "created_at",
            "updated_at",
        )
    )


def last_year(fact: DataFrame, mode: str = "rows") -> DataFrame:
    """Add sales_vs_ly, the amount of the same store and department a year ago.

    ``rows`` looks 52 rows back, whatever weeks are missing; ``calendar`` at the
    week exactly 364 days earlier. A series runs on over the versions of its
    store, whose keys differ. ``date_key`` sorts like the date, so no calendar
    join is needed. A window holds the weeks of one store and department:
    bounded by the calendar.
    """
    by_series = Window.partitionBy(series_key(F.col("sales_key")))
    if mode == "rows":
        earlier = F.lag("weekly_sales", 52).over(by_series.orderBy("date_key"))
    elif mode == "calendar":
        day = F.unix_date(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
        # At most one row: a series has one row a day.
        earlier = F.max("weekly_sales").over(by_series.orderBy(day).rangeBetween(-364, -364))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return fact.withColumn("sales_vs_ly", earlier)


def with_growth(fact: DataFrame) -> DataFrame:
    """Add sales_growth_pct (clamped to ±999.99) to rows with sales_vs_ly."""
    last = F.col("sales_vs_ly")
    growth = F.round(percent_change(F.col("weekly_sales"), last), 2)
    clamped = F.least(F.lit(999.99).cast(PERCENT), F.greatest(F.lit(-999.99).cast(PERCENT), growth))
    return fact.withColumn("sales_growth_pct", F.when(last > 0, clamped).cast(PERCENT))


def fact_yoy(fact: DataFrame, mode: str = "rows") -> DataFrame:
    """Add sales_vs_ly and sales_growth_pct; see last_year for ``mode``."""
    return with_growth(last_year(fact, mode))


# --- views ----------------------------------------------------------------------


def current_stores_view(stores: DataFrame) -> DataFrame:
    return stores.filter("is_current").select(
        "store_key",
        "store_id",
        "store_type",
        "store_type_description",
        "store_size",
        "size_category",
        "region",
        "state",
        "city",
    )


def sales_by_store_type(fact: DataFrame, stores: DataFrame, dates: DataFrame) -> DataFrame:
    """Stores, total, average, highest and lowest sale by type and quarter.

    The fact is first summed per store and quarter, so that the store join and
    the distinct count see a fraction of the rows and no store is hot.
    """
    quarters = dates.select("date_key", "year", "quarter_name")
    per_store = (
        fact.join(quarters, "date_key")
        .groupBy("store_key", "year", "quarter_name")
        .agg(
            F.sum("weekly_sales").alias("total"),
            F.count("weekly_sales").alias("n"),
            F.max("weekly_sales").alias("highest"),
            F.min("weekly_sales").alias("lowest"),
        )
    )
    return (
        per_store.join(stores.select("store_key", "store_id", "store_type"), "store_key")
        .groupBy("store_type", "year", "quarter_name")
        .agg(
            F.countDistinct("store_id").alias("num_stores"),
            F.sum("total").alias("total_sales"),
            mean_of(F.sum("total"), F.sum("n")).alias("avg_weekly_sales"),
            F.max("highest").alias("max_weekly_sales"),
            F.min("lowest").alias("min_weekly_sales"),
        )
    )


def promotion_effectiveness_view(fact: DataFrame, promotions: DataFrame) -> DataFrame:
    """Sales against markdown cost by promotion type and number of markdowns.

    A markdown belongs to a store and week but counts once per department row,
    which inflates cost and lowers the return; kept as the view defines it.
    The fact is summed per promotion before the join, so no key is hot.
    """
    per_key = (
        fact.filter(F.col("promotion_key") != 0)
        .groupBy("promotion_key")
        .agg(F.count("*").alias("n"), F.sum("weekly_sales").alias("sales"))
    )
    cost = F.sum(F.col("total_markdown") * F.col("n"))
    return (
        per_key.join(promotions.filter("promotion_type <> 'None'"), "promotion_key")
        .groupBy("promotion_type", "num_markdowns")
        .agg(
            F.sum("n").alias("num_observations"),
            F.sum("sales").alias("total_sales"),
            mean_of(F.sum("sales"), F.sum("n")).alias("avg_sales"),
            mean_of(cost, F.sum("n")).alias("avg_markdown_cost"),
            quotient(F.sum("sales"), cost).alias("roi"),
        )
    )
