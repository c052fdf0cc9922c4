"""Every query by name, over inputs derived from the order-lines tables.

The queries read the clean and star-schema tables, as they do in a warehouse.
Here those tables are derived from ``lineitem``; each is written once per
application to the shared folder and read from there, so that a query scans
the columns it needs of the tables it needs, and no query repeats the work of
another. A table is only made when a query asks for it.
"""

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators import keys as key_ops
from tillwright.operators.latest import latest_per_key
from tillwright.operators.lookup import as_of_dimension
from tillwright.operators.merge import insert_absent, upsert
from tillwright.operators.scd2 import scd2_from_history
from tillwright.plans import gold, marts, models, quality, reports, silver
from tillwright.plans.build import FOREIGN_KEYS, MONTH, Warehouse, build, kept_totals
from tillwright.schemas import TABLE_KEYS
from tillwright.sources import model_store, orderlines
from tillwright.sources.files import append_raw
from tillwright.sources.orderlines import LOAD1, LOAD2
from tillwright.sources.shared import shared_folder
from tillwright.sources.tables import drop_staged, shuffles_removed, staged_count, table_rows

#: Tables that are kept by month, as in the warehouse.
BY_MONTH = ("silver.sales", "silver.features")
_RUN = uuid.uuid4().hex[:12]
_DONE = {}


def _state(spark: SparkSession, sf_dir: str) -> list:
    """Names, sizes and times of the input files: changed input is derived anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found)


class Tables:
    """Derived tables of one input folder, made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        source = hashlib.md5(f"{sf_dir} {_state(spark, sf_dir)}".encode()).hexdigest()[:8]
        app = spark.sparkContext.applicationId
        self.root = f"{shared_folder(spark)}/derived/{app}-{_RUN}-{source}"

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.root}/{name.replace('.', '/')}"
        if path not in _DONE:
            frame = BUILDERS[name](self)
            with shuffles_removed(self.spark):
                self._keep(name, frame, path)
            _DONE[path] = True
        if name == "platinum.base":
            return marts.kept_base(self.spark, path)
        return self.spark.read.parquet(path)

    def once(self, name: str) -> DataFrame:
        """A table for one reader: not written for it if no query has needed it yet."""
        known = f"{self.root}/{name.replace('.', '/')}" in _DONE
        return self(name) if known else BUILDERS[name](self)

    def _keep(self, name: str, frame: DataFrame, path: str) -> None:
        if name.startswith("bronze."):
            append_raw(frame, path)
        elif name == "platinum.base":
            marts.keep_base(frame, path)
        elif name in BY_MONTH:
            # A month's rows in the order of stores: a scan skips months, and the pages of other stores.
            dated = frame.withColumn(MONTH, F.trunc("date", "month"))
            dated = dated.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "store_id", "date")
            dated.write.mode("overwrite").partitionBy(MONTH).parquet(path)
        else:
            frame.write.mode("overwrite").parquet(path)


BUILDERS = {
    "raw.sales": lambda t: orderlines.raw_sales(t.spark, t.sf_dir),
    "raw.features": lambda t: orderlines.raw_features(t.spark, t.sf_dir),
    "raw.stores1": lambda t: orderlines.raw_stores(t("raw.sales"), 1),
    "raw.stores2": lambda t: orderlines.raw_stores(t("raw.sales"), 2),
    "bronze.sales": lambda t: orderlines.bronze_sales(t("raw.sales")),
    "bronze.features": lambda t: orderlines.bronze_features(t("raw.features")),
    "bronze.stores": lambda t: orderlines.bronze_stores(t("raw.stores1"), t("raw.stores2")),
    "silver.sales": lambda t: silver.silver_sales(t("bronze.sales"), LOAD2),
    "silver.features": lambda t: silver.silver_features(t("bronze.features"), LOAD2),
    "silver.stores": lambda t: store_history(t),
    "gold.dim_date": lambda t: gold.dim_date_from_facts(t("silver.sales"), t("silver.features")),
    "gold.dim_store": lambda t: gold.dim_store(t("silver.stores")),
    "gold.dim_department": lambda t: gold.dim_department(t("silver.sales")),
    "gold.dim_promotion": lambda t: gold.dim_promotion(t("silver.features")),
    "gold.dim_economic": lambda t: gold.dim_economic(t("silver.features")),
    "gold.fact_base": lambda t: fact_base(t),
    "gold.fact_sales": lambda t: gold.fact_yoy(t("gold.fact_base")),
    "platinum.base": lambda t: marts.weekly_base(t("silver.sales"), t("silver.features")),
    "platinum.promotion": lambda t: marts.promotion_mart(t("platinum.base"), t("silver.stores")),
    "platinum.trend": lambda t: marts.trend_mart(t("platinum.base"), t("silver.stores")),
}


def store_history(t: Tables) -> DataFrame:
    first = silver.silver_stores(t("bronze.stores"), None, LOAD1)
    return silver.silver_stores(t("bronze.stores"), first, LOAD2)


def store_history_from_snapshots(t: Tables) -> DataFrame:
    day = F.to_date("ingestion_timestamp")
    snapshots = (
        t("bronze.stores")
        .filter(F.col("type").isin("A", "B", "C") & (F.col("size") > 0))
        .select(
            F.col("store").alias("store_id"),
            F.col("type").alias("store_type"),
            F.col("size").alias("store_size"),
            day.alias("snapshot_date"),
        )
        .distinct()
    )
    return scd2_from_history(snapshots, "store_id", ["store_type", "store_size"], "snapshot_date")


def fact_base(t: Tables) -> DataFrame:
    resolved = gold.feature_keys(
        t("silver.features"), t("gold.dim_promotion"), t("gold.dim_economic")
    )
    return gold.fact_sales(
        gold.changed_since(t("silver.sales"), LOAD2),
        t("gold.dim_date"),
        t("gold.dim_store"),
        t("gold.dim_department"),
        resolved,
    )


def silver_two_loads(t: Tables) -> DataFrame:
    """Clean sales after both load days: insert, overwrite, keep."""
    earlier = silver.silver_sales(t("bronze.sales"), LOAD1)
    batch = silver.silver_sales(t("bronze.sales"), LOAD2)
    merged = upsert(
        earlier,
        batch,
        ["store_id", "department_id", "date"],
        silver.SALES_VALUES,
        ["updated_at"],
    )
    return merged.select(
        "store_id",
        "department_id",
        "date",
        "weekly_sales",
        F.to_date("created_at").alias("created_on"),
        F.to_date("updated_at").alias("updated_on"),
    )


def all_store_weeks(t: Tables) -> DataFrame:
    """Store weeks known from features, plus those only sales know."""
    known = t("silver.features").select("store_id", "date", F.lit("features").alias("known_from"))
    sold = t("silver.sales").select("store_id", "date").distinct()
    return insert_absent(
        known, sold.withColumn("known_from", F.lit("sales")), ["store_id", "date"]
    )


def sales_as_of_version(t: Tables) -> DataFrame:
    """Sales by the store version valid 14 years after the sale, NULL where none is.

    Sales are summed per store and week first: the lookup needs no more, and a
    store with very many rows then brings one row per week to the join.
    """
    weeks = reports.store_weeks(t("silver.sales"))
    shifted = weeks.withColumn("valid_day", F.add_months("date", 14 * 12))
    joined = as_of_dimension(shifted, t("gold.dim_store"), "store_id", "valid_day", "left")
    return joined.groupBy("store_id", "version", "store_type", "size_category").agg(
        F.sum("n").alias("num_sales"), F.sum("sales").alias("total_sales")
    )


def latest_features(t: Tables) -> DataFrame:
    """The newest week of each store."""
    rows = t("silver.features").select("store_id", "date", "temperature", "cpi")
    return latest_per_key(rows, ["store_id"], [F.desc("date")])


def default_department_sales(t: Tables) -> DataFrame:
    """Sales by the category and group of the pre-populated departments; those of
    other departments are "Unmapped"."""
    per_department = (
        t("silver.sales")
        .groupBy("department_id")
        .agg(F.sum("weekly_sales").alias("sales"), F.count("*").alias("n"))
    )
    return (
        per_department.join(gold.dim_department_default(t.spark), "department_id", "left")
        .groupBy(
            F.coalesce("department_category", F.lit("Unmapped")).alias("department_category"),
            F.coalesce("department_group", F.lit("Unmapped")).alias("department_group"),
        )
        .agg(F.sum("sales").alias("total_sales"), F.sum("n").alias("num_records"))
    )


def calendar_of_sales(t: Tables) -> DataFrame:
    """A gapless calendar over the range of sales dates."""
    bounds = t("silver.sales").agg(
        F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )
    return gold.calendar_between(bounds)


def keyed_weeks(t: Tables) -> DataFrame:
    """Numbered (store, week) rows: surrogate keys over a table of any size."""
    weeks = t("silver.features").select("store_id", "date")
    return key_ops.surrogate_key(weeks, ["date", "store_id"], "week_key")


def training(t: Tables) -> DataFrame:
    return reports.training_frame(t("silver.sales"), t("silver.stores"), t("silver.features"))


def promotions(t: Tables) -> DataFrame:
    return reports.promotion_frame(t("silver.sales"), t("silver.stores"), t("silver.features"))


def model_root(t: Tables) -> str:
    """The folder of both models, trained at their default size and saved on first use."""
    root = f"{t.root}/models"
    if root not in _DONE:
        others = staged_count()
        models.train_all(training(t), promotions(t), root)
        drop_staged(t.spark, keep=others)
        _DONE[root] = True
    return root


def _counts(t: Tables, name: str) -> DataFrame:
    """A model's errors and row counts."""
    errors = ", ".join(f"{e} double" for e in ("mae", "mae_of_mean", "r2", "training_mae", "training_mae_of_mean"))
    metrics = f"{errors}, training_rows long, test_rows long, trees long"
    about = models.model_status(t.spark, model_root(t)).filter(F.col("model") == name)
    return about.select(F.from_json("metrics", metrics).alias("of")).select("of.*")


def trained_forecaster(t: Tables) -> DataFrame:
    """The forecaster's counts, and what must hold of its errors."""
    table = model_store.load_model(model_root(t), models.SALES_MODEL).table
    whole = table.agg(F.countDistinct("tree").alias("trees_grown"))
    return _counts(t, models.SALES_MODEL).crossJoin(whole).select(  # one row each
        "training_rows",
        "test_rows",
        "trees_grown",
        (F.col("training_mae") < F.col("training_mae_of_mean")).alias("fits_training_rows"),
        # The given amounts follow no feature: there a deep forest errs a little more than the mean.
        (F.col("mae") < 1.1 * F.col("mae_of_mean")).alias("holds_on_test_rows"),
    )


def forecaster_metrics(t: Tables) -> DataFrame:
    return _counts(t, models.SALES_MODEL)


def promoter_metrics(t: Tables) -> DataFrame:
    return _counts(t, models.PROMOTION_MODEL).drop("trees")


def promoter(t: Tables):
    return model_store.load_model(model_root(t), models.PROMOTION_MODEL)


def forecasts(t: Tables) -> DataFrame:
    requests = t("silver.sales").select("store_id", "department_id", "date", "is_holiday").join(
        t("silver.features").drop("is_holiday", "created_at", "updated_at"),
        ["store_id", "date"],
        "left",
    )
    return models.score_sales(requests, model_store.load_model(model_root(t), models.SALES_MODEL))


def forecast_bounds(t: Tables) -> DataFrame:
    """One row per request: its number of forecasts, and whether they lie within the
    amounts the forest has seen."""
    seen = t("silver.sales").agg(F.min("weekly_sales").alias("least"), F.max("weekly_sales").alias("most")).first()
    within = F.col("predicted_sales").between(float(seen["least"]), float(seen["most"]))
    return forecasts(t).groupBy("store_id", "department_id", "date").agg(
        F.count("predicted_sales").alias("forecasts"), F.bool_and(within).alias("within_sales_seen")
    )


def allocations(t: Tables) -> DataFrame:
    requests = t("silver.sales").groupBy("store_id", "department_id").agg(
        (F.sum(F.abs("weekly_sales")) / 100 + 1).cast("double").alias("budget"),
        F.lit(False).alias("is_holiday"),
    )
    return models.optimize_markdown(requests, t("silver.stores"), promoter(t))


def trained_status(t: Tables) -> DataFrame:
    status = models.model_status(t.spark, model_root(t))
    counts = F.from_json("metrics", "training_rows long, test_rows long")
    return status.select("model", "trained", "version", counts.alias("of")).select("model", "trained", "version", "of.*")


def enough_rows(t: Tables) -> DataFrame:
    """Whether the training guard accepts the table, beside its full row count."""
    frame = training(t)
    accepted = models.has_enough_rows(frame)
    return frame.agg(F.count("*").alias("training_rows")).withColumn("accepted", F.lit(accepted))


def warehouse(t: Tables) -> Warehouse:
    """A warehouse built by the daily run over both load days."""
    root = f"{t.root}/warehouse"
    if root not in _DONE:
        for name in ("stores", "features", "sales"):
            with shuffles_removed(t.spark):
                append_raw(t.once(f"bronze.{name}").drop("ingest_date"), f"{root}/bronze/{name}")
        for day in (LOAD1, LOAD2):
            build(t.spark, root, day)
        _DONE[root] = True
    return Warehouse(t.spark, root)


def warehouse_fact(t: Tables) -> DataFrame:
    """The fact that the daily run leaves, with what its dimension keys stand for."""
    tables = warehouse(t)
    promotions = tables.read("gold.dim_promotion").select("promotion_key", "promotion_type", "total_markdown")
    economics = tables.read("gold.dim_economic").select("economic_key", "temperature", "fuel_price", "cpi", "unemployment")
    fact = tables.read("gold.fact_sales").join(promotions, "promotion_key").join(economics, "economic_key")
    return fact.drop("promotion_key", "economic_key", "month_key", "series_part", *silver.STAMPS)


def warehouse_checks(t: Tables) -> DataFrame:
    """The checks that the last run kept the totals of, over the whole fact."""
    tables = warehouse(t)
    rows = table_rows(t.spark, tables.path("silver.sales"))
    return quality.checks_of_totals(kept_totals(tables), FOREIGN_KEYS, rows)


def warehouse_trend(t: Tables) -> DataFrame:
    return warehouse(t).read("platinum.trend")


CHECKED_TABLES = [name for name in TABLE_KEYS]


def _sales_stores_features(t: Tables):
    return t("silver.sales"), t("silver.stores"), t("silver.features")


def _stores_without_times(df: DataFrame) -> DataFrame:
    return df.drop("ingestion_timestamp", "source_file", "ingest_date")


QUERIES = {
    # raw layer
    "ingest_stores": lambda t: _stores_without_times(t("bronze.stores")),
    "ingest_features": lambda t: _stores_without_times(t("bronze.features")),
    "ingest_sales": lambda t: _stores_without_times(t("bronze.sales")),
    # clean layer
    "silver_stores": lambda t: store_history(t),
    "silver_stores_from_history": store_history_from_snapshots,
    "silver_features": lambda t: silver.silver_features(t("bronze.features"), LOAD2).drop(
        *silver.STAMPS
    ),
    "silver_sales": lambda t: silver.silver_sales(t("bronze.sales"), LOAD2).drop(*silver.STAMPS),
    # table operators
    "upsert_sales": silver_two_loads,
    "insert_absent_weeks": all_store_weeks,
    "latest_features": latest_features,
    "surrogate_keys": keyed_weeks,
    "as_of_store_version": sales_as_of_version,
    # star schema
    "dim_date": lambda t: gold.dim_date_from_facts(t("silver.sales"), t("silver.features")),
    "dim_date_range": calendar_of_sales,
    "dim_store": lambda t: gold.dim_store(
        t("silver.stores"), gold.store_efficiency(t("silver.stores"), t("silver.sales"))
    ).drop("region", "state", "city"),
    "dim_department": lambda t: gold.dim_department(t("silver.sales")).drop("avg_margin_pct"),
    "dim_department_default": default_department_sales,
    "dim_promotion": lambda t: gold.dim_promotion(t("silver.features")),
    "dim_economic": lambda t: gold.dim_economic(t("silver.features")),
    "fact_sales": lambda t: fact_base(t).drop(*silver.STAMPS),
    "fact_yoy": lambda t: gold.fact_yoy(t("gold.fact_base")).drop(*silver.STAMPS),
    "fact_yoy_calendar": lambda t: gold.fact_yoy(t("gold.fact_base"), "calendar").drop(
        *silver.STAMPS
    ),
    "current_stores": lambda t: gold.current_stores_view(t("gold.dim_store")).drop(
        "region", "state", "city"
    ),
    "sales_by_store_type": lambda t: gold.sales_by_store_type(
        t("gold.fact_sales"), t("gold.dim_store"), t("gold.dim_date")
    ),
    "gold_promotion_effectiveness": lambda t: gold.promotion_effectiveness_view(
        t("gold.fact_sales"), t("gold.dim_promotion")
    ),
    # the daily run
    "warehouse_fact": warehouse_fact,
    "warehouse_checks": warehouse_checks,
    "warehouse_trend": warehouse_trend,
    # marts
    "promotion_mart": lambda t: marts.promotion_mart(t("platinum.base"), t("silver.stores")),
    "trend_mart": lambda t: marts.trend_mart(t("platinum.base"), t("silver.stores")),
    "trend_growth": lambda t: marts.trend_growth(t("platinum.trend")),
    # reports
    "kpi_summary": lambda t: reports.kpi_summary(t("silver.sales")),
    "date_hierarchy": lambda t: reports.date_hierarchy(t("silver.sales")),
    "fiscal_hierarchy": lambda t: reports.fiscal_hierarchy(t("silver.sales")),
    "top_departments": lambda t: reports.top_departments(t("silver.sales")),
    "cpi_impact": lambda t: reports.cpi_impact(*_sales_stores_features(t)),
    "unemployment_impact": lambda t: reports.unemployment_impact(*_sales_stores_features(t)),
    "store_list": lambda t: reports.store_list(t("silver.stores"), t("silver.sales")),
    "store_performance": lambda t: reports.store_performance(t("silver.sales"), 1),
    "compare_stores": lambda t: reports.compare_stores(t("silver.sales"), t("silver.stores"), 1, 2),
    "promotion_effectiveness": lambda t: reports.promotion_effectiveness(*_sales_stores_features(t)),
    "promotion_effectiveness_type_a": lambda t: reports.promotion_effectiveness(
        *_sales_stores_features(t), store_type="A"
    ),
    "markdown_ranking": lambda t: reports.markdown_ranking(*_sales_stores_features(t)),
    "training_frame": training,
    "features_frame": lambda t: reports.features_frame(t("silver.features")),
    "promotion_frame": promotions,
    "training_frame_raw": lambda t: reports.training_frame_raw(
        t("raw.sales"), t("raw.stores1"), t("raw.features")
    ),
    "promotion_frame_raw": lambda t: reports.promotion_frame_raw(
        t("raw.sales"), t("raw.stores1"), t("raw.features")
    ),
    "week_snapshot": lambda t: reports.week_snapshot(t("silver.features"), "1998-12-25"),
    "top_holiday_departments": lambda t: reports.top_holiday_departments(t("silver.sales")),
    "sales_with_economics": lambda t: reports.sales_with_economics(
        t("silver.sales"), t("silver.features"), "1998-01-01", "1998-12-31"
    ),
    "negative_sales": lambda t: reports.negative_sales(t("silver.sales")),
    "current_store_info": lambda t: reports.current_store_info(t("silver.stores")),
    # data quality
    "check_nan_markdowns": lambda t: quality.nan_markdowns(
        t("bronze.features"), t("silver.features")
    ),
    "check_row_counts": lambda t: quality.row_counts({n: t(n) for n in CHECKED_TABLES}),
    "check_date_range": lambda t: quality.date_range(t("bronze.sales")),
    "check_negative_sales": lambda t: quality.negative_sales_profile(t("bronze.sales")),
    "check_store_types": lambda t: quality.store_type_distribution(t("bronze.stores")),
    "check_null_sales": lambda t: quality.null_sales(t("silver.sales")),
    "check_sales_without_store": lambda t: quality.sales_without_store(
        t("silver.sales"), t("silver.stores")
    ),
    "check_invalid_indicators": lambda t: quality.invalid_indicators(t("silver.features")),
    "check_dates_without_features": lambda t: quality.dates_without_features(
        t("silver.sales"), t("silver.features")
    ),
    "check_fact_null_keys": lambda t: quality.fact_null_keys(t("gold.fact_sales")),
    "check_fact_orphans": lambda t: quality.fact_orphans(
        t("gold.fact_sales"),
        {
            "date_key": t("gold.dim_date"),
            "store_key": t("gold.dim_store"),
            "department_key": t("gold.dim_department"),
            "promotion_key": t("gold.dim_promotion"),
            "economic_key": t("gold.dim_economic"),
        },
    ),
    "check_count_drift": lambda t: quality.count_drift(t("gold.fact_sales"), t("silver.sales")),
    "check_value_rules": lambda t: quality.value_rules(
        t("silver.stores"), t("silver.features"), t("gold.dim_date")
    ),
    "check_unique_keys": lambda t: quality.unique_tables(
        {n: t(n) for n in CHECKED_TABLES}, TABLE_KEYS
    ),
    "check_store_history": lambda t: quality.scd2_invariants(t("silver.stores")),
    "check_week_alignment": lambda t: quality.week_alignment(
        t("silver.sales"), t("silver.features")
    ),
    # models
    "train_sales_forecaster": trained_forecaster,
    "forecaster_metrics": forecaster_metrics,
    "train_promotion_impact": promoter_metrics,
    "score_sales": forecast_bounds,
    "forecast_sales": forecasts,
    "optimize_markdown": allocations,
    "model_status": trained_status,
    "training_guard": enough_rows,
}
