"""The daily warehouse run over a root folder of Parquet tables.

``bronze.*`` tables are appended by ``sources.files.ingest``; ``build`` takes
it from there. Every step can be repeated: running the same day twice changes
nothing. A ledger keeps which load days each clean table holds and up to which run
the marts and the fact follow, so a run takes whatever is due: a day whose run
failed or never came, and every corrected sale or feature row, reach all tables with
the next run that ends. The fact is checked before any of it is replaced, by its
changed partitions and the kept totals of the others.
"""

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators.keys import series_key
from tillwright.operators.merge import upsert
from tillwright.plans import gold, marts, quality, silver
from tillwright.schemas import MONEY, TABLE_KEYS
from tillwright.sources.bucketed import is_written
from tillwright.sources.tables import (
    append_rows,
    current,
    discard,
    drop_staged,
    exists,
    merge_table,
    partition_values,
    read_table,
    replace_partitions,
    replace_table,
    shuffles_removed,
    staged,
    staged_count,
    table_path,
    table_rows,
)

MONTH = "month_start"
#: The fact's partitions: months, and parts of the series (store, department) in them.
FACT_MONTH, SERIES_PART = "month_key", "series_part"
#: The promotion mart's partitions: the months that its weeks begin in.
WEEK_MONTH = "week_month"
LEDGER, CHECKS = "ops.ledger", "ops.fact_checks"
#: Days before any load.
ALL_DAYS = 100_000


class Warehouse:
    """The tables under one root folder. ``series_parts``: how finely a fact is cut by series."""

    def __init__(self, spark: SparkSession, root: str, series_parts: int = 8):
        self.spark, self.root, self.series_parts = spark, root, series_parts

    def path(self, name: str) -> str:
        return table_path(self.root, name)

    def has(self, name: str) -> bool:
        return exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        if name.startswith("bronze."):  # only ever appended to, so a plain folder
            return self.spark.read.parquet(self.path(name))
        return read_table(self.spark, self.path(name))

    def read_if_any(self, name: str) -> DataFrame | None:
        return self.read(name) if self.has(name) else None


    def done(self, step: str) -> list[str]:
        """The days up to now on which ``step`` ended, ascending."""
        ledger = self.read_if_any(LEDGER)  # a row for each step and day
        return sorted(r["day"] for r in ledger.filter(F.col("step") == step).collect()) if ledger else []

    def mark(self, step: str, days) -> None:
        rows = self.spark.createDataFrame([(step, d) for d in sorted(set(days))], "step string, day string")
        if rows.count():
            merge_table(self.spark, self.path(LEDGER), rows, ["step", "day"], [])

    def unmark(self, step: str, as_of) -> None:
        if _day(as_of) in self.done(step):
            ledger = self.read(LEDGER)
            replace_table(ledger.filter((F.col("step") != step) | (F.col("day") != _day(as_of))), self.path(LEDGER))

    def due_loads(self, name: str, as_of) -> list[str]:
        """Load days of a raw table up to ``as_of`` that its clean table doesn't hold yet."""
        loaded = partition_values(self.spark, self.path(f"bronze.{name}"), "ingest_date")
        done = set(self.done(f"silver.{name}"))
        return [d for d in loaded if d <= _day(as_of) and d not in done]

    def days_since(self, step: str, as_of, least: int) -> int:
        """How far back changes may lie that ``step`` hasn't taken yet, ``least`` days at least."""
        ended = [d for d in self.done(step) if d <= _day(as_of)]
        if not ended:
            return ALL_DAYS
        # What a run of that day stamped is taken: a day isn't done while it runs again.
        return max(least, (date.fromisoformat(_day(as_of)) - date.fromisoformat(ended[-1])).days - 1)


def _day(as_of) -> str:
    return str(as_of)[:10]


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.trunc("date", "month"))


def build_silver(warehouse: Warehouse, as_of) -> None:
    """Clean the loads of ``as_of`` and those due from before, and merge them into the
    silver tables. Store versions follow day by day; of the other tables' loads the
    latest row of a key wins."""
    spark = warehouse.spark
    due = warehouse.due_loads("stores", as_of)
    for day in sorted({*due, _day(as_of)}):
        stores = silver.silver_stores(
            warehouse.read("bronze.stores"), warehouse.read_if_any("silver.stores"), day
        )
        replace_table(stores, warehouse.path("silver.stores"))
    warehouse.mark("silver.stores", due)
    for name, clean, keys, values in (
        ("features", silver.silver_features, ["store_id", "date"], silver.FEATURE_VALUES),
        ("sales", silver.silver_sales, ["store_id", "department_id", "date"], silver.SALES_VALUES),
    ):
        due = warehouse.due_loads(name, as_of)
        batch = clean(warehouse.read(f"bronze.{name}"), as_of, due)
        merge_table(
            spark,
            warehouse.path(f"silver.{name}"),
            _by_month(batch),
            keys,
            values,
            touch_cols=["updated_at"],
            partition_by=MONTH,
        )
        warehouse.mark(f"silver.{name}", due)


def _neighbours(months, *steps: int) -> list[date]:
    """The months, and those ``steps`` months from each."""
    return sorted({date(m.year + (m.month - 1 + s) // 12, (m.month - 1 + s) % 12 + 1, 1) for m in months for s in (0, *steps)})


def build_platinum(warehouse: Warehouse, as_of) -> None:
    """Bring the weekly base and both marts up to date.

    Only months with a changed row are read again into the base. It is kept in
    buckets of series, from which the marts follow without a shuffle: the promotion
    mart's weeks that touch those months, and the trend as a whole, since a
    week is compared over its whole series. A store that changed renews both marts.
    """
    stores, sales = warehouse.read("silver.stores"), warehouse.read("silver.sales")
    features, path = warehouse.read("silver.features"), warehouse.path("platinum.base")
    days = warehouse.days_since("platinum", as_of, gold.FACT_LOOKBACK_DAYS)
    changed = gold.changed_with_features(sales, features, as_of, days)
    whole = days == ALL_DAYS or not is_written(warehouse.spark, path)
    if not whole:
        since = F.date_sub(F.lit(_day(as_of)).cast("date"), days)
        whole = stores.filter(F.col("effective_date") >= since).limit(1).count() > 0
    # One value per calendar month.
    months = [r[0] for r in (sales if whole else changed).select(MONTH).distinct().collect()]
    if months:
        some = [df.filter(F.col(MONTH).isin(months)).drop(MONTH) for df in (sales, features)]
        base = marts.keep_base(marts.weekly_base(*some), path, MONTH)
        weeks = _neighbours(months, -1)  # a week belongs to the month it begins in
        near = base.filter(F.col(MONTH).isin(_neighbours(weeks, 1)))
        promotion = marts.promotion_mart(near, stores).withColumn(WEEK_MONTH, F.trunc("week_start", "month"))
        rows = promotion.filter(F.col(WEEK_MONTH).isin(weeks))
        if whole:
            replace_table(rows, warehouse.path("platinum.promotion"), WEEK_MONTH)
        else:
            replace_partitions(rows, warehouse.path("platinum.promotion"), WEEK_MONTH)
        replace_table(marts.trend_mart(base, stores), warehouse.path("platinum.trend"))
    warehouse.mark("platinum", [_day(as_of)])


def _grow_dimension(warehouse: Warehouse, name: str, first, fresh) -> None:
    """Append the rows ``fresh(existing)`` to a dimension that starts as ``first``."""
    path = warehouse.path(name)
    if not warehouse.has(name):
        replace_table(first, path)
    append_rows(fresh(warehouse.read(name)), path)


def build_dimensions(warehouse: Warehouse) -> None:
    spark = warehouse.spark
    sales, features = warehouse.read("silver.sales"), warehouse.read("silver.features")
    dates = gold.dim_date_from_facts(sales, features, warehouse.read_if_any("gold.dim_date"))
    replace_table(dates, warehouse.path("gold.dim_date"))
    stores = warehouse.read("silver.stores")
    replace_table(gold.dim_store(stores, gold.store_efficiency(stores, sales)), warehouse.path("gold.dim_store"))
    departments = gold.dim_department(sales, warehouse.read_if_any("gold.dim_department"))
    replace_table(departments, warehouse.path("gold.dim_department"))
    _grow_dimension(
        warehouse,
        "gold.dim_promotion",
        gold.no_promotion(spark),
        lambda known: gold.new_promotions(features, known),
    )
    _grow_dimension(
        warehouse,
        "gold.dim_economic",
        gold.unknown_economics(spark),
        lambda known: gold.new_economics(features, known),
    )


def fact_batch(warehouse: Warehouse, as_of) -> DataFrame:
    """Fact rows of the sales that changed, or whose features did, since the fact last followed."""
    days = warehouse.days_since("gold.fact_sales", as_of, gold.FACT_LOOKBACK_DAYS)
    keys = gold.feature_keys(
        warehouse.read("silver.features"),
        warehouse.read("gold.dim_promotion"),
        warehouse.read("gold.dim_economic"),
    )
    return gold.fact_sales(
        gold.changed_with_features(
            warehouse.read("silver.sales"), warehouse.read("silver.features"), as_of, days
        ),
        warehouse.read("gold.dim_date"),
        warehouse.read("gold.dim_store"),
        warehouse.read("gold.dim_department"),
        keys,
    )


def _month() -> Column:
    return (F.col("date_key") / 100).cast("int")


def _series_part(parts: int) -> Column:
    return F.pmod(F.xxhash64(series_key(F.col("sales_key"))), F.lit(parts)).cast("int")


def _partitioned(rows: DataFrame, parts: int) -> DataFrame:
    return rows.withColumns({FACT_MONTH: _month(), SERIES_PART: _series_part(parts)})


def moved_comparisons(fact: DataFrame, batch: DataFrame, parts: int) -> DataFrame:
    """sales_key, date_key, sales_vs_ly of the rows whose comparison ``batch``
    changes: of the fact, only the parts that hold a series of the batch are read,
    three columns of them."""
    # At most ``parts`` numbers, used as a partition filter.
    read = [r[0] for r in batch.select(_series_part(parts)).distinct().collect()]
    touched = batch.select(series_key(F.col("sales_key")).alias("_series")).distinct()
    thin = ["sales_key", "date_key", "weekly_sales"]
    stored = (
        fact.filter(F.col(SERIES_PART).isin(read))
        .select(*thin, F.col("sales_vs_ly").alias("_stored"))
        .withColumn("_series", series_key(F.col("sales_key")))
        .join(touched, "_series", "left_semi")
        .drop("_series")
    )
    fresh = batch.select(*thin, F.lit(None).cast(MONEY).alias("_stored"))
    compared = gold.last_year(upsert(stored, fresh, ["sales_key"], ["weekly_sales"]))
    moved = compared.filter(~F.col("sales_vs_ly").eqNullSafe(F.col("_stored")))
    return moved.select("sales_key", "date_key", "sales_vs_ly")


def _among(pairs) -> Column:
    """Rows in one of the (month, part) partitions, as a filter that prunes them."""
    by_part: dict = {}
    for month, part in pairs:
        by_part.setdefault(part, []).append(month)
    tests = [(F.col(SERIES_PART) == part) & F.col(FACT_MONTH).isin(months) for part, months in sorted(by_part.items())]
    return reduce(or_, tests, F.lit(False))


def kept_totals(warehouse: Warehouse) -> DataFrame:
    """What the checks count, by partition of the fact: kept from the run that wrote it,
    or else counted anew. Dimensions keep all keys they ever had, so a row that had its
    dimension rows has them still."""
    version = current(warehouse.spark, warehouse.path("gold.fact_sales")).version
    kept = warehouse.read_if_any(CHECKS)
    if kept is not None and kept.filter(F.col("fact_version") == version).limit(1).count():
        return kept.drop("fact_version")
    return quality.fact_totals(warehouse.read("gold.fact_sales"), _dimensions(warehouse), [FACT_MONTH, SERIES_PART])


def build_fact(warehouse: Warehouse, as_of, validate: bool = True) -> None:
    """Merge changed sales into the fact and bring year-over-year up to date.

    Keyed by (store, department, date), not by store version: a late correction
    moves a row to the current version, never doubles it. Only partitions (a month of
    some series) that hold a row of the batch, or one whose comparison it changes,
    are read whole, checked and rewritten. With ``validate`` a table that fails
    its checks is left as it was, and the changes are due again.
    """
    spark, path, parts = warehouse.spark, warehouse.path("gold.fact_sales"), warehouse.series_parts
    batch = staged(fact_batch(warehouse, as_of))
    if not batch.limit(1).count():
        warehouse.mark("gold.fact_sales", [_day(as_of)])
        return
    by = [FACT_MONTH, SERIES_PART]
    if not warehouse.has("gold.fact_sales"):
        rows = staged(_partitioned(gold.fact_yoy(batch), parts))
        others = None
    else:
        fact = warehouse.read("gold.fact_sales")
        moved = staged(moved_comparisons(fact, batch, parts))
        keyed = batch.select("sales_key", "date_key").union(moved.select("sales_key", "date_key"))
        # At most a row for each partition, used as a partition filter.
        pairs = [tuple(r) for r in _partitioned(keyed, parts).select(*by).distinct().collect()]
        affected = fact.filter(_among(pairs)).select(*batch.columns, "sales_vs_ly")
        fresh = batch.withColumn("sales_vs_ly", F.lit(None).cast(MONEY))
        merged = upsert(affected, fresh, ["sales_key"], gold.FACT_UPDATES, ["updated_at"])
        new = moved.select("sales_key", F.col("sales_vs_ly").alias("_new"), F.lit(True).alias("_moved"))
        now = F.when(F.col("_moved"), F.col("_new")).otherwise(F.col("sales_vs_ly"))
        compared = merged.join(new, "sales_key", "left").withColumn("sales_vs_ly", now)
        whole = gold.with_growth(compared.drop("_new", "_moved"))
        rows = staged(_partitioned(whole, parts))
        discard(moved)
        others = kept_totals(warehouse).filter(~_among(pairs))
    discard(batch)
    totals = quality.fact_totals(rows, _dimensions(warehouse), by)
    totals = staged(totals if others is None else others.unionByName(totals))
    if validate:
        sales_rows = table_rows(spark, warehouse.path("silver.sales"))
        quality.require(quality.checks_of_totals(totals, FOREIGN_KEYS, sales_rows))
    replace_partitions(rows, path, by)
    version = current(spark, path).version
    replace_table(totals.withColumn("fact_version", F.lit(version)), warehouse.path(CHECKS))
    warehouse.mark("gold.fact_sales", [_day(as_of)])


FOREIGN_KEYS = {
    "date_key": "gold.dim_date",
    "store_key": "gold.dim_store",
    "department_key": "gold.dim_department",
    "promotion_key": "gold.dim_promotion",
    "economic_key": "gold.dim_economic",
}


def _dimensions(warehouse: Warehouse) -> dict:
    return {key: warehouse.read(name) for key, name in FOREIGN_KEYS.items()}


def star_schema_checks(warehouse: Warehouse) -> DataFrame:
    """The checks that stop a run, over the whole fact."""
    fact, sales = warehouse.read("gold.fact_sales"), warehouse.read("silver.sales")
    return (
        quality.fact_null_keys(fact)
        .unionByName(quality.fact_orphans(fact, _dimensions(warehouse)))
        .unionByName(quality.count_drift(fact, sales))
    )


def all_checks(warehouse: Warehouse) -> DataFrame:
    """The stopping checks, value rules, key uniqueness and version history."""
    tables = {name: warehouse.read(name) for name in TABLE_KEYS if warehouse.has(name)}
    return (
        star_schema_checks(warehouse)
        .unionByName(
            quality.value_rules(
                tables["silver.stores"], tables["silver.features"], tables["gold.dim_date"]
            )
        )
        .unionByName(quality.unique_tables(tables, TABLE_KEYS))
        .unionByName(quality.scd2_invariants(tables["silver.stores"]))
    )


def build(spark: SparkSession, root: str, as_of, validate: bool = True) -> Warehouse:
    """Run silver, platinum and gold for the loads of ``as_of`` and all that is due before."""
    warehouse = Warehouse(spark, root)
    others = staged_count()
    try:
        with shuffles_removed(spark):
            for step in ("platinum", "gold.fact_sales"):
                warehouse.unmark(step, as_of)
            build_silver(warehouse, as_of)
            build_platinum(warehouse, as_of)
            build_dimensions(warehouse)
            build_fact(warehouse, as_of, validate)
    finally:
        drop_staged(spark, keep=others)
    return warehouse
