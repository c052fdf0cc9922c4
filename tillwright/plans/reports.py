"""Business questions over the clean layer.

Reports that only need sales per store and week start from ``store_weeks``,
which sums the departments away before features or store attributes are
joined: the joins then see one row per store and week, whatever the number of
departments, and a store that holds much of the data is no longer hot.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwright.functions import bands
from tillwright.functions.dates import fiscal_period, fiscal_quarter, fiscal_year
from tillwright.functions.numeric import (
    exact_mean,
    markdown_total,
    mean2,
    mean_of,
    nan_to_null,
    or_zero,
    percent_change,
    ratio,
)
from tillwright.operators.medians import exact_medians
from tillwright.schemas import INDICATORS, MARKDOWNS, TOTAL
from tillwright.sources.tables import staged

# What a missing feature counts as in training data.
TRAINING_DEFAULTS = {
    "temperature": 60.0,
    "fuel_price": 3.0,
    **{m: 0.0 for m in MARKDOWNS},
    "cpi": 210.0,
    "unemployment": 8.0,
}


def _total(column) -> Column:
    return F.sum(column).cast(TOTAL)


def _holiday(column="weekly_sales") -> Column:
    return F.when(F.col("is_holiday"), F.col(column))


def _normal(column="weekly_sales") -> Column:
    return F.when(~F.col("is_holiday"), F.col(column))


def current(stores: DataFrame, *columns) -> DataFrame:
    return stores.filter("is_current").select("store_id", *columns)


def store_weeks(sales: DataFrame) -> DataFrame:
    """Total and row count per store and date."""
    return sales.groupBy("store_id", "date").agg(
        F.sum("weekly_sales").alias("sales"), F.count("weekly_sales").alias("n")
    )


def between_days(df: DataFrame, first, last) -> DataFrame:
    """Rows with ``first <= date <= last``; prunes the months of a table
    partitioned by ``month_start``."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    rows = df.filter(F.col("date").between(low, high))
    if "month_start" in df.columns:
        rows = rows.filter(F.col("month_start").between(F.trunc(low, "month"), high))
    return rows


# --- sales --------------------------------------------------------------------


def kpi_summary(sales: DataFrame) -> DataFrame:
    """One row of headline figures. Averages have two decimals."""
    lift = percent_change(exact_mean(_holiday()), exact_mean(_normal()))
    return sales.agg(
        F.countDistinct("store_id").alias("num_stores"),
        F.countDistinct("department_id").alias("num_departments"),
        F.countDistinct("date").alias("num_weeks"),
        _total("weekly_sales").alias("total_sales"),
        mean2(F.col("weekly_sales")).alias("avg_weekly_sales"),
        mean2(_holiday()).alias("avg_holiday_sales"),
        mean2(_normal()).alias("avg_normal_sales"),
        F.round(lift, 2).alias("holiday_lift_pct"),
    )


def _hierarchy(days: DataFrame, columns) -> DataFrame:
    """Totals of every level of ``columns``, the widest first; ``level`` names the one a row is of."""
    totals = days.rollup(*columns).agg(
        F.sum("amount").cast(TOTAL).alias("total_sales"),
        F.sum("n").alias("num_records"),
        F.grouping_id().alias("_id"),
    )
    # Rolled up from the right, the id of the level that lacks n columns is 2^n - 1.
    names = [*[c[: -len("_start")] if c.endswith("_start") else c for c in reversed(columns)], "all"]
    level = F.element_at(F.array(*[F.lit(n) for n in names]), F.bit_count("_id").cast("int") + 1)
    return totals.select(level.alias("level"), *columns, "total_sales", "num_records")


def _by_day(sales: DataFrame) -> DataFrame:
    """Sales are summed by day first: no later row depends on a store or department."""
    return sales.groupBy("date").agg(F.sum("weekly_sales").alias("amount"), F.count("*").alias("n"))


def date_hierarchy(sales: DataFrame) -> DataFrame:
    """Sales by year, quarter, month, week and day, and their totals on every level."""
    days = _by_day(sales).select(
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.trunc("date", "week").alias("week_start"),
        F.col("date").alias("day"),
        "amount",
        "n",
    )
    return _hierarchy(days, ["year", "quarter", "month", "week_start", "day"])


def fiscal_hierarchy(sales: DataFrame) -> DataFrame:
    """Sales by fiscal year, quarter and period, and their totals on every level."""
    day = F.col("date")
    periods = [fiscal_year(day).alias("fiscal_year"), fiscal_quarter(day).alias("fiscal_quarter"), fiscal_period(day).alias("fiscal_period")]
    return _hierarchy(_by_day(sales).select(*periods, "amount", "n"), ["fiscal_year", "fiscal_quarter", "fiscal_period"])


def top_departments(sales: DataFrame, k: int = 10) -> DataFrame:
    return (
        sales.groupBy("department_id")
        .agg(
            _total("weekly_sales").alias("total_sales"),
            mean2(F.col("weekly_sales")).alias("avg_weekly_sales"),
            F.countDistinct("store_id").alias("num_stores"),
        )
        .orderBy(F.desc("total_sales"), "department_id")
        .limit(k)
    )


def store_list(stores: DataFrame, sales: DataFrame) -> DataFrame:
    """Current stores with sales, best first."""
    per_store = sales.groupBy("store_id").agg(
        _total("weekly_sales").alias("total_sales"),
        mean2(F.col("weekly_sales")).alias("avg_weekly_sales"),
        F.countDistinct("department_id").alias("active_departments"),
        F.countDistinct("date").alias("weeks_recorded"),
    )
    return (
        current(stores, "store_type", "store_size")
        .join(per_store, "store_id")
        .orderBy(F.desc("total_sales"), "store_id")
    )


def store_performance(sales: DataFrame, store_id: int) -> DataFrame:
    """Figures per department of one store."""
    amount = F.col("weekly_sales")
    return (
        sales.filter(F.col("store_id") == store_id)
        .groupBy("department_id")
        .agg(
            _total("weekly_sales").alias("total_sales"),
            mean2(amount).alias("avg_weekly_sales"),
            F.max(amount).alias("max_weekly_sales"),
            F.min(amount).alias("min_weekly_sales"),
            F.count_if("is_holiday").alias("holiday_weeks"),
            mean2(_holiday()).alias("avg_holiday_sales"),
            mean2(_normal()).alias("avg_normal_sales"),
        )
        .orderBy(F.desc("total_sales"), "department_id")
    )


def compare_stores(sales: DataFrame, stores: DataFrame, store_a: int, store_b: int) -> DataFrame:
    """Two stores side by side in one row; no row unless both have sales."""
    metrics = ["total_sales", "avg_weekly_sales", "num_departments", "store_type", "store_size"]
    wanted = F.col("store_id").isin(store_a, store_b)
    per_store = (
        sales.filter(wanted)
        .groupBy("store_id")
        .agg(
            _total("weekly_sales").alias("total_sales"),
            mean2(F.col("weekly_sales")).alias("avg_weekly_sales"),
            F.countDistinct("department_id").alias("num_departments"),
        )
        .join(current(stores, "store_type", "store_size").filter(wanted), "store_id")
    )

    def side(store, suffix):
        mine = F.col("store_id") == store
        return [F.max(F.when(mine, F.col(m))).alias(f"{m}_{suffix}") for m in metrics]

    a, b = F.col("total_sales_a"), F.col("total_sales_b")
    base = F.greatest(b, F.lit(1).cast(TOTAL))
    return (
        per_store.agg(*side(store_a, "a"), *side(store_b, "b"))
        .filter(a.isNotNull() & b.isNotNull())
        .select(
            F.lit(store_a).alias("store_a"),
            F.lit(store_b).alias("store_b"),
            *[f"{m}_{suffix}" for suffix in "ab" for m in metrics],
            (a - b).alias("sales_diff"),
            F.round(ratio((a - b) * 100, base), 2).alias("sales_diff_pct"),
        )
    )


def top_holiday_departments(sales: DataFrame, k: int = 10) -> DataFrame:
    return (
        sales.filter("is_holiday")
        .groupBy("department_id")
        .agg(_total("weekly_sales").alias("total_holiday_sales"), F.count("*").alias("num_weeks"))
        .orderBy(F.desc("total_holiday_sales"), "department_id")
        .limit(k)
    )


def negative_sales(sales: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most negative weekly amounts."""
    return (
        sales.filter("weekly_sales < 0")
        .select("store_id", "department_id", "date", "weekly_sales")
        .orderBy("weekly_sales", "store_id", "department_id", "date")
        .limit(k)
    )


def current_store_info(stores: DataFrame) -> DataFrame:
    return current(stores, "store_type", "store_size", "effective_date").orderBy("store_id")


# --- economics ------------------------------------------------------------------


def _impact(sales: DataFrame, stores: DataFrame, features: DataFrame, band: Column, name: str):
    defaults = {c: TRAINING_DEFAULTS[c] for c in ("cpi", "unemployment")}
    weeks = (
        store_weeks(sales)
        .join(current(stores), "store_id", "left_semi")
        .join(features.select("store_id", "date", *defaults), ["store_id", "date"], "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items()})
    )
    return (
        weeks.groupBy(band.alias(name))
        .agg(mean_of(F.sum("sales"), F.sum("n")).alias("avg_sales"), F.sum("n").alias("records"))
        .orderBy(F.desc("avg_sales"), name)
    )


def cpi_impact(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Average sale by CPI band (< 200, <= 220, above)."""
    band = bands.mixed_band(F.col("cpi"), 200, 220, bands.CPI_IMPACT_BANDS)
    return _impact(sales, stores, features, band, "cpi_band")


def unemployment_impact(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Average sale by unemployment band (< 5, <= 8, above)."""
    band = bands.mixed_band(F.col("unemployment"), 5, 8, bands.UNEMPLOYMENT_IMPACT_BANDS)
    return _impact(sales, stores, features, band, "unemp_band")


def week_snapshot(features: DataFrame, day) -> DataFrame:
    """Economic figures and total markdown of every store in one week."""
    return (
        between_days(features, day, day)
        .select(
            "store_id",
            "temperature",
            "fuel_price",
            markdown_total().alias("total_markdown"),
            "cpi",
            "unemployment",
            "is_holiday",
        )
        .orderBy("store_id")
    )


def sales_with_economics(sales: DataFrame, features: DataFrame, first, last) -> DataFrame:
    """Sales rows of a date range with their economic context.

    The range is put on both sides of the join, so both scans skip what lies
    outside of it.
    """
    context = between_days(features, first, last).select(
        "store_id", "date", "temperature", "fuel_price", "markdown1", "cpi", "unemployment"
    )
    return (
        between_days(sales, first, last)
        .select("store_id", "department_id", "date", "weekly_sales")
        .join(context, ["store_id", "date"], "left")
        .select("store_id", "department_id", "date", "weekly_sales", *context.columns[2:])
        .orderBy("date", "store_id", "department_id")
    )


# --- promotions -----------------------------------------------------------------


def promotion_effectiveness(
    sales: DataFrame,
    stores: DataFrame,
    features: DataFrame,
    store_id: int | None = None,
    store_type: str | None = None,
    limit: int = 50,
) -> DataFrame:
    """Sales, markdown sums and return per store, best sellers first.

    A store's markdown of a week counts once per department sold that week,
    which inflates markdown and lowers the return; kept as the report defines
    it. ``store_id`` and ``store_type`` filter when given.
    """
    chosen = current(stores, "store_type")
    if store_id is not None:
        sales = sales.filter(F.col("store_id") == store_id)
        features = features.filter(F.col("store_id") == store_id)
    if store_type is not None:
        chosen = chosen.filter(F.col("store_type") == store_type)
    spent = {m: F.coalesce(F.sum(F.col(m) * F.col("n")), F.lit(0)).cast(TOTAL) for m in MARKDOWNS}
    total = markdown_total("_").cast(TOTAL)
    return (
        store_weeks(sales)
        .join(features.select("store_id", "date", *MARKDOWNS), ["store_id", "date"], "left")
        .groupBy("store_id")
        .agg(_total("sales").alias("total_sales"), *[s.alias(f"_{m}") for m, s in spent.items()])
        .join(chosen, "store_id")
        .select(
            "store_id",
            "store_type",
            "total_sales",
            *[F.col(f"_{m}").alias(f"total_md{i}") for i, m in enumerate(MARKDOWNS, 1)],
            total.alias("total_markdown"),
            F.round(ratio(F.col("total_sales"), total), 4).alias("roi"),
        )
        .orderBy(F.desc("total_sales"), "store_id")
        .limit(limit)
    )


def markdown_ranking(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Average sale with and without each markdown, and the lift, best first."""
    weeks = (
        store_weeks(sales)
        .join(current(stores), "store_id", "left_semi")
        .join(features.select("store_id", "date", *MARKDOWNS), ["store_id", "date"], "left")
    )
    slots = [
        F.struct(
            F.lit(f"MarkDown{i}").alias("markdown_type"),
            F.coalesce(F.col(m), F.lit(0)).alias("markdown"),
        )
        for i, m in enumerate(MARKDOWNS, 1)
    ]
    active, idle = F.col("markdown") > 0, F.col("markdown") == 0

    def average(side):
        total, rows = F.sum(F.when(side, F.col("sales"))), F.sum(F.when(side, F.col("n")))
        return F.coalesce(F.round(ratio(total.cast(TOTAL), rows), 2), F.lit(0)).cast(TOTAL)

    with_md, without = F.col("avg_sales_with_markdown"), F.col("avg_sales_without_markdown")
    base = F.greatest(without, F.lit(1).cast(TOTAL))
    return (
        weeks.select("sales", "n", F.inline(F.array(*slots)))
        .groupBy("markdown_type")
        .agg(
            F.coalesce(F.sum(F.when(active, F.col("n"))), F.lit(0)).alias("weeks_active"),
            average(active).alias("avg_sales_with_markdown"),
            average(idle).alias("avg_sales_without_markdown"),
        )
        .withColumn("avg_sales_lift_pct", F.round(ratio((with_md - without) * 100, base), 2))
        .orderBy(F.desc("avg_sales_lift_pct"), "markdown_type")
    )


# --- frames for training ----------------------------------------------------------


def with_date_features(frame: DataFrame) -> DataFrame:
    d = F.col("date")
    return frame.withColumns(
        {
            "week_of_year": F.weekofyear(d),
            "month": F.month(d),
            "year": F.year(d),
            "quarter": F.quarter(d),
        }
    )


def _with_features(sales, stores, features, attributes, values) -> DataFrame:
    columns = [F.coalesce(F.col(c), F.lit(TRAINING_DEFAULTS[c])).alias(c) for c in values]
    return (
        sales.select("store_id", "department_id", "date", "weekly_sales", "is_holiday")
        .join(current(stores, *attributes), "store_id")
        .join(features.select("store_id", "date", *values), ["store_id", "date"], "left")
        .select(
            "store_id",
            "department_id",
            "date",
            "weekly_sales",
            "is_holiday",
            *attributes,
            *columns,
        )
    )


def training_frame(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Sales with store attributes, features (defaults where missing) and date parts."""
    values = ["temperature", "fuel_price", *MARKDOWNS, "cpi", "unemployment"]
    doubles = features.select("store_id", "date", *[F.col(v).cast("double").alias(v) for v in values])
    return with_date_features(
        _with_features(sales, stores, doubles, ["store_type", "store_size"], values)
    )


def promotion_frame(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Sales with store type and markdowns (0 where missing)."""
    doubles = features.select("store_id", "date", *[F.col(m).cast("double").alias(m) for m in MARKDOWNS])
    return _with_features(sales, stores, doubles, ["store_type"], MARKDOWNS)


def features_frame(features: DataFrame) -> DataFrame:
    return features.select(
        "store_id", "date", "temperature", "fuel_price", *MARKDOWNS, "cpi", "unemployment", "is_holiday"
    ).orderBy("store_id", "date")


def _raw_named(sales, stores, features) -> list:
    """The three source files with lower-case, conformed column names."""
    lower = [df.toDF(*[c.lower() for c in df.columns]) for df in (sales, stores, features)]
    renames = {
        "store": "store_id",
        "dept": "department_id",
        "isholiday": "is_holiday",
        "type": "store_type",
        "size": "store_size",
    }
    return [df.withColumnsRenamed(renames) for df in lower]


def training_frame_raw(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """The training frame from the source files alone.

    A markdown missing in a feature row is 0, and stays NULL for a sale
    without feature row. Missing indicators get the median over all sales
    rows. Store types become codes in alphabetical order of those present,
    -1 where unknown.
    """
    sales, stores, features = _raw_named(sales, stores, features)
    keys = ["store_id", "date"]
    features = features.select(
        *keys,
        *[or_zero(F.col(m)).alias(m) for m in MARKDOWNS],
        *[nan_to_null(F.col(c)).alias(c) for c in INDICATORS],
    )
    # A sale's indicators depend on its store and week alone, so the medians
    # are taken over store weeks, weighted by their sales rows.
    weights = sales.groupBy(*keys).agg(F.count("*").alias("n"))
    weeks = staged(weights.join(features.select(*keys, *INDICATORS), keys, "left"))
    medians = exact_medians(weeks, INDICATORS, weight="n")

    # A store type is one letter, so the distinct types are a handful of rows.
    seen = weeks.select("store_id").distinct()
    types = stores.join(seen, "store_id", "left_semi").select("store_type").distinct()
    code = F.row_number().over(Window.orderBy("store_type")) - 1
    codes = types.filter("store_type IS NOT NULL").select("store_type", code.alias("_code"))
    coded = stores.join(codes, "store_type", "left").select(
        "store_id", F.coalesce("_code", F.lit(-1)).alias("store_type"), "store_size"
    )
    frame = (
        sales.join(coded, "store_id", "left")
        .join(features, keys, "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(medians[c])) for c in INDICATORS})
        .withColumn("store_type", F.coalesce("store_type", F.lit(-1)))
    )
    return with_date_features(frame)


def promotion_frame_raw(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """The promotion frame from the source files alone; missing markdowns are 0."""
    sales, stores, features = _raw_named(sales, stores, features)
    return (
        sales.join(stores.select("store_id", "store_type"), "store_id", "left")
        .join(features.select("store_id", "date", *MARKDOWNS), ["store_id", "date"], "left")
        .withColumns({m: or_zero(F.col(m)) for m in MARKDOWNS})
    )
