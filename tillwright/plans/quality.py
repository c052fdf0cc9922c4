"""Data-quality checks. Each returns rows of (check, value, passed).

``value`` is what was counted or measured; ``passed`` is whether the rule
holds, and true for figures that are only reported.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwright.functions.numeric import mean_of
from tillwright.schemas import MARKDOWNS, MONEY


def _rows(totals: DataFrame, results) -> DataFrame:
    """Turn one row of aggregates into one row per (name, value, passed)."""
    structs = [
        F.struct(
            F.lit(name).alias("check"),
            value.cast("double").alias("value"),
            F.coalesce(passed, F.lit(True)).alias("passed"),
        )
        for name, value, passed in results
    ]
    return totals.select(F.inline(F.array(*structs)))


def _none(value: Column) -> Column:
    return value == 0


def _counted(df: DataFrame, rules: dict, must_be_zero: bool = True) -> DataFrame:
    """Count the rows meeting each rule in one pass."""
    names = list(rules)
    totals = df.agg(*[F.count_if(rules[n]).alias(f"v{i}") for i, n in enumerate(names)])
    passed = _none if must_be_zero else (lambda value: F.lit(True))
    return _rows(totals, [(n, F.col(f"v{i}"), passed(F.col(f"v{i}"))) for i, n in enumerate(names)])


def _measured(df: DataFrame, measures: dict) -> DataFrame:
    names = list(measures)
    totals = df.agg(*[measures[n].alias(f"v{i}") for i, n in enumerate(names)])
    return _rows(totals, [(n, F.col(f"v{i}"), F.lit(True)) for i, n in enumerate(names)])


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def nan_markdowns(bronze_features: DataFrame, silver_features: DataFrame) -> DataFrame:
    """NaN markdowns: reported in the raw layer, forbidden in the clean one."""
    raw = {f"bronze nan {m}": F.isnan(m) for m in MARKDOWNS}
    clean = {f"silver nan {m}": F.isnan(F.col(m).cast("double")) for m in MARKDOWNS}
    return _counted(bronze_features, raw, must_be_zero=False).unionByName(
        _counted(silver_features, clean)
    )


def row_counts(tables: dict) -> DataFrame:
    """Rows per table."""
    return _union([_measured(df, {f"rows {name}": F.count("*")}) for name, df in tables.items()])


def date_range(sales: DataFrame, day: str = "date") -> DataFrame:
    """First and last date (as yyyymmdd) and number of distinct dates."""

    def number(d):
        return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)

    return _measured(
        sales,
        {
            "earliest date": number(F.min(day)),
            "latest date": number(F.max(day)),
            "unique weeks": F.countDistinct(day),
        },
    )


def negative_sales_profile(sales: DataFrame) -> DataFrame:
    # Raw amounts are doubles; whole cents make the average independent of row order.
    amount = F.col("weekly_sales").cast(MONEY)
    return _measured(
        sales,
        {
            "sales records": F.count("*"),
            "negative sales": F.count_if(amount < 0),
            "min sales": F.min(amount),
            "max sales": F.max(amount),
            "avg sales": mean_of(F.sum(amount), F.count(amount)),
        },
    )


def store_type_distribution(stores: DataFrame) -> DataFrame:
    """Count and sizes of raw store rows by type; the average is a whole number."""
    return stores.groupBy("type").agg(
        F.count("*").alias("num_stores"),
        F.round(F.avg(F.col("size")), 0).cast("int").alias("avg_size"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
    )


def null_sales(sales: DataFrame) -> DataFrame:
    return _counted(sales, {"null weekly_sales": F.col("weekly_sales").isNull()})


def _unmatched(fact: DataFrame, key: str, dim: DataFrame, name: str, dim_key: str | None = None):
    """Rows of ``fact`` whose key is missing in ``dim``.

    Rows are counted per key first, so the join sees each key once.
    """
    known = dim.select(F.col(dim_key or key).alias(key))
    missing = fact.groupBy(key).agg(F.count("*").alias("n")).join(known, key, "left_anti")
    totals = missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v"))
    return _rows(totals, [(name, F.col("v"), _none(F.col("v")))])


def sales_without_store(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return _unmatched(sales, "store_id", stores.filter("is_current"), "sales without current store")


def invalid_indicators(features: DataFrame) -> DataFrame:
    unemployment = F.col("unemployment")
    return _counted(
        features,
        {
            "invalid cpi": F.col("cpi") <= 0,
            "invalid unemployment": (unemployment < 0) | (unemployment > 100),
        },
    )


def dates_without_features(sales: DataFrame, features: DataFrame) -> DataFrame:
    """Dates on which some store has sales but no feature row (reported as rows)."""
    keys = ["store_id", "date"]
    return sales.select(*keys).distinct().join(features, keys, "left_anti").select("date").distinct()


def fact_null_keys(fact: DataFrame) -> DataFrame:
    keys = ["date_key", "store_key", "department_key"]
    return _counted(fact, {f"null {k}": F.col(k).isNull() for k in keys})


def fact_orphans(fact: DataFrame, dims: dict) -> DataFrame:
    """Fact rows without dimension row, for each of ``{key: dimension}``."""
    return _union([_unmatched(fact, key, dim, f"orphan {key}") for key, dim in dims.items()])


def count_drift(fact: DataFrame, sales: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Difference of fact and clean row counts, allowed up to ``tolerance``."""
    sides = fact.select(F.lit(1).alias("f"), F.lit(0).alias("s")).unionByName(
        sales.select(F.lit(0).alias("f"), F.lit(1).alias("s"))
    )
    totals = sides.agg(F.sum("f").alias("f"), F.sum("s").alias("s"))
    drift = F.abs(F.col("f") - F.col("s"))
    return _rows(totals, [("fact vs silver count drift", drift, drift <= F.col("s") * tolerance)])


def fact_totals(fact: DataFrame, dims: dict, by) -> DataFrame:
    """What the fact's checks count, by ``by``: (…, check, value)."""
    null_keys = ["date_key", "store_key", "department_key"]
    counted = {"rows": F.count("*"), **{f"null {k}": F.count_if(F.col(k).isNull()) for k in null_keys}}
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), c.alias("value")) for n, c in counted.items()])
    totals = fact.groupBy(*by).agg(pairs.alias("of")).select(*by, F.inline("of"))
    for key, dim in dims.items():
        known = dim.select(key)
        missing = fact.groupBy(*by, key).agg(F.count("*").alias("value")).join(known, key, "left_anti")
        totals = totals.unionByName(missing.groupBy(*by).agg(F.lit(f"orphan {key}").alias("check"), F.sum("value").alias("value")))
    return totals


def checks_of_totals(totals: DataFrame, dims, sales_rows: int, tolerance: float = 0.01) -> DataFrame:
    """The checks of nulls, orphans and count drift, from ``fact_totals`` of all parts of the fact."""
    names = [f"null {k}" for k in ("date_key", "store_key", "department_key")] + [f"orphan {k}" for k in dims]
    of = {n: F.coalesce(F.sum(F.when(F.col("check") == n, F.col("value"))), F.lit(0)) for n in [*names, "rows"]}
    whole = totals.agg(*[c.alias(f"v{i}") for i, c in enumerate(of.values())])
    drift = F.abs(F.col(f"v{len(names)}") - F.lit(sales_rows))
    return _rows(
        whole,
        [(n, F.col(f"v{i}"), _none(F.col(f"v{i}"))) for i, n in enumerate(names)]
        + [("fact vs silver count drift", drift, drift <= F.lit(sales_rows) * tolerance)],
    )


def value_rules(stores: DataFrame, features: DataFrame, calendar: DataFrame) -> DataFrame:
    """The declared value constraints, as counts of violating rows."""

    def outside(column, low, high):
        return ~F.col(column).between(low, high)

    return _union(
        [
            _counted(
                stores,
                {
                    "store type not A, B, C": ~F.col("store_type").isin("A", "B", "C"),
                    "store size not positive": F.col("store_size") <= 0,
                    "effective after end": F.col("effective_date") > F.col("end_date"),
                },
            ),
            _counted(
                features,
                {
                    "fuel price negative": F.col("fuel_price") < 0,
                    "cpi not positive": F.col("cpi") <= 0,
                    "unemployment outside 0..100": outside("unemployment", 0, 100),
                },
            ),
            _counted(
                calendar,
                {
                    "month outside 1..12": outside("month_number", 1, 12),
                    "quarter outside 1..4": outside("quarter_number", 1, 4),
                    "week outside 1..53": outside("week_of_year", 1, 53),
                    "day outside 1..31": outside("day_of_month", 1, 31),
                    "day of year outside 1..366": outside("day_of_year", 1, 366),
                    "weekday outside 1..7": outside("day_of_week", 1, 7),
                },
            ),
        ]
    )


def duplicate_keys(df: DataFrame, keys, name: str) -> DataFrame:
    """Number of key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    totals = repeated.agg(F.count("*").alias("v"))
    label = f"duplicate {name} ({', '.join(keys)})"
    return _rows(totals, [(label, F.col("v"), _none(F.col("v")))])


def unique_tables(tables: dict, table_keys: dict) -> DataFrame:
    """Uniqueness of every declared key of the tables given."""
    return _union(
        [
            duplicate_keys(df, keys, name)
            for name, df in tables.items()
            for keys in table_keys.get(name, [])
        ]
    )


def scd2_invariants(stores: DataFrame) -> DataFrame:
    """Exactly one current version per store, versions without gap or overlap."""
    by_store = Window.partitionBy("store_id").orderBy("version")
    following = F.lead("effective_date").over(by_store)
    chained = stores.withColumns(
        {
            "_gap": following.isNotNull() & (F.datediff(following, "end_date") != 1),
            "_version_gap": F.col("version") != F.row_number().over(by_store),
        }
    )
    per_store = chained.groupBy("store_id").agg(
        F.count_if("is_current").alias("current"),
        F.count_if("_gap").alias("gaps"),
        F.count_if("_version_gap").alias("version_gaps"),
    )
    return _counted(
        per_store,
        {
            "stores without exactly one current version": F.col("current") != 1,
            "stores with gap or overlap": F.col("gaps") > 0,
            "stores with missing version numbers": F.col("version_gaps") > 0,
        },
    )


def week_alignment(sales: DataFrame, features: DataFrame) -> DataFrame:
    """Sales dates are Fridays; holiday flags of sales and features agree."""
    per_week = sales.groupBy("store_id", "date", "is_holiday").agg(F.count("*").alias("n"))
    weeks = per_week.join(
        features.select("store_id", "date", F.col("is_holiday").alias("_flag")),
        ["store_id", "date"],
        "left",
    )
    off_friday = F.sum(F.when(F.weekday("date") != 4, F.col("n")).otherwise(0))
    differing = F.sum(F.when(F.col("is_holiday") != F.col("_flag"), F.col("n")).otherwise(0))
    totals = weeks.agg(
        F.coalesce(off_friday, F.lit(0)).alias("a"), F.coalesce(differing, F.lit(0)).alias("b")
    )
    return _rows(
        totals,
        [
            ("sales not on a Friday", F.col("a"), _none(F.col("a"))),
            ("holiday flags that differ", F.col("b"), _none(F.col("b"))),
        ],
    )


def require(checks: DataFrame) -> None:
    """Raise if a check failed, naming the failed ones."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        names = ", ".join(f"{row['check']} = {row['value']:g}" for row in failed)
        raise ValueError(f"data quality checks failed: {names}")
