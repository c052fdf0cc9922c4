"""The daily run over several load days, the stream, CSV faults and sources."""

import os
import re
from datetime import timedelta
from decimal import Decimal

import pytest
from helpers import bronze_features, bronze_sales, bronze_stores, d, rows
from pyspark.sql import functions as F

from tillwright import schemas
from tillwright.plans import build as builds
from tillwright.plans import registry, silver
from tillwright.plans.build import Warehouse, build
from tillwright.sources import tables
from tillwright.sources.files import append_raw, ingest, read_csv
from tillwright.sources.training import training_source
from tillwright.streaming.silver import stream_sales

DAYS = ["2011-07-01", "2011-07-08", "2011-07-15"]
WEEKS = [str(d("2010-02-05") + timedelta(weeks=i)) for i in range(60)]
TABLES = [
    "silver.stores", "silver.features", "silver.sales", "platinum.promotion", "platinum.trend",
    "gold.dim_date", "gold.dim_store", "gold.dim_department", "gold.dim_promotion",
    "gold.dim_economic", "gold.fact_sales",
]


def load(spark, root, day, stores=(), features=(), sales=()):
    """Append one day's raw rows; an empty list appends no row but the columns."""
    at = f"{day} 01:00:00"
    append_raw(bronze_stores(spark, [(*s, at) for s in stores]), f"{root}/bronze/stores")
    weekly = [{"store": s, "date": d(w), **rest, "at": at} for s, w, rest in features]
    append_raw(bronze_features(spark, weekly), f"{root}/bronze/features")
    append_raw(bronze_sales(spark, [(*s, at) for s in sales]), f"{root}/bronze/sales")


@pytest.fixture(scope="module")
def three_days(spark, tmp_path_factory):
    """Day 1: all weeks but the third. Day 2: store 1 grows, one sale and one
    week's markdown are corrected. Day 3: the week left out comes late."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    amounts = {w: 100.0 + i for i, w in enumerate(WEEKS)}
    load(
        spark, root, DAYS[0], [(1, "A", 10), (2, "B", 20)], [(1, w, {}) for w in WEEKS],
        [(s, 1, w, a * s, False) for w, a in amounts.items() for s in (1, 2) if (s, w) != (1, WEEKS[2])],
    )
    build(spark, root, DAYS[0])
    load(spark, root, DAYS[1], [(1, "A", 15)], [(1, WEEKS[10], {"markdown1": 7000.0})], [(1, 1, WEEKS[0], 50.0, False)])
    build(spark, root, DAYS[1])
    load(spark, root, DAYS[2], sales=[(1, 1, WEEKS[2], 7.0, False)])
    build(spark, root, DAYS[2])
    return Warehouse(spark, root)


def day_of(column):
    return F.to_date(column).cast("string").alias(column)


def test_store_history(three_days):
    history = three_days.read("silver.stores").select(
        "store_id", "store_size", "version", "is_current", F.col("effective_date").cast("string")
    )
    assert rows(history) == [
        (1, 10, 1, False, DAYS[0]), (1, 15, 2, True, DAYS[1]), (2, 20, 1, True, DAYS[0]),
    ]


def test_fact_after_three_days(three_days):
    fact = three_days.read("gold.fact_sales")
    assert fact.count() == 120
    stamped = fact.filter("created_at <> updated_at OR created_at > '2011-07-02'").select(
        "date_key", day_of("created_at"), day_of("updated_at"), "weekly_sales", (F.col("promotion_key") > 0).alias("promoted")
    )
    assert rows(stamped) == [
        (20100205, DAYS[0], DAYS[1], Decimal("50.00"), False),
        (20100219, DAYS[2], DAYS[2], Decimal("7.00"), False),
        (20100416, DAYS[0], DAYS[1], Decimal("110.00"), True),
    ]


def test_comparisons_run_over_store_versions(three_days):
    fact = three_days.read("gold.fact_sales").filter(F.col("sales_key") < (2 << 32)).orderBy("date_key").collect()
    assert len({r["store_key"] for r in fact}) == 2
    amounts = [r["weekly_sales"] for r in fact]
    assert [r["sales_vs_ly"] for r in fact] == [None] * 52 + amounts[:8]
    growth = [r["sales_growth_pct"] for r in fact[52:54]]
    assert growth == [Decimal("204.00"), round((amounts[53] / amounts[1] - 1) * 100, 2)]


def contents(warehouse):
    return {name: rows(warehouse.read(name)) for name in TABLES}


def test_a_repeated_day_changes_nothing(three_days):
    before = contents(three_days)
    build(three_days.spark, three_days.root, DAYS[2])
    assert contents(three_days) == before
    assert all(r["passed"] for r in builds.all_checks(three_days).collect())


def test_a_failed_check_leaves_the_fact(three_days, monkeypatch):
    before = rows(three_days.read("gold.fact_sales"))

    def refuse(_checks):
        raise ValueError("refused")

    monkeypatch.setattr(builds.quality, "require", refuse)
    with pytest.raises(ValueError, match="refused"):
        builds.build_fact(three_days, DAYS[2])
    assert rows(three_days.read("gold.fact_sales")) == before
    tables.drop_staged(three_days.spark)


def unstamped(warehouse):
    return {n: rows(warehouse.read(n).drop("created_at", "updated_at")) for n in TABLES}


def test_days_without_a_run_and_failed_ones_are_made_up_for(spark, three_days, tmp_path, monkeypatch):
    """The first day fails its checks, the second isn't run at all, and the third runs late."""
    root = str(tmp_path)
    for name in ("stores", "features", "sales"):
        raw = spark.read.parquet(f"{three_days.root}/bronze/{name}").filter(F.col("ingest_date") == DAYS[0])
        raw.write.partitionBy("ingest_date").parquet(f"{root}/bronze/{name}")
    with monkeypatch.context() as patch:
        patch.setattr(builds.quality, "require", lambda _checks: (_ for _ in ()).throw(ValueError("refused")))
        with pytest.raises(ValueError, match="refused"):
            build(spark, root, DAYS[0])
    warehouse = Warehouse(spark, root)
    assert not warehouse.has("gold.fact_sales") and warehouse.done("gold.fact_sales") == []
    for name in ("stores", "features", "sales"):
        raw = spark.read.parquet(f"{three_days.root}/bronze/{name}").filter(F.col("ingest_date") > DAYS[0])
        raw.write.mode("append").partitionBy("ingest_date").parquet(f"{root}/bronze/{name}")
    assert warehouse.due_loads("sales", "2011-07-18") == [DAYS[1], DAYS[2]]
    build(spark, root, "2011-07-18")
    assert warehouse.done("silver.sales") == DAYS and warehouse.done("gold.fact_sales") == ["2011-07-18"]
    late, in_time = unstamped(warehouse), unstamped(three_days)
    # Numbered in the order in which runs met them; a sale gets the store version of its run.
    keys = "promotion_key", "economic_key", "store_key"
    for name in TABLES:
        if name != "gold.fact_sales":
            assert late[name] == in_time[name], name
    facts = [rows(w.read("gold.fact_sales").drop("created_at", "updated_at", *keys)) for w in (warehouse, three_days)]
    assert facts[0] == facts[1]


def test_kept_totals_give_the_checks_of_the_whole_fact(three_days):
    kept = three_days.read(builds.CHECKS)
    version = tables.current(three_days.spark, three_days.path("gold.fact_sales")).version
    assert {r["fact_version"] for r in kept.select("fact_version").distinct().collect()} == {version}
    sales_rows = tables.table_rows(three_days.spark, three_days.path("silver.sales"))
    assert sales_rows == 120
    found = builds.quality.checks_of_totals(builds.kept_totals(three_days), builds.FOREIGN_KEYS, sales_rows)
    assert rows(found) == rows(builds.star_schema_checks(three_days))
    counted = builds.quality.fact_totals(three_days.read("gold.fact_sales"), builds._dimensions(three_days), [builds.FACT_MONTH, builds.SERIES_PART])
    assert rows(builds.kept_totals(three_days)) == rows(counted.select(*builds.kept_totals(three_days).columns))


def test_totals_find_nulls_orphans_and_drift(spark, three_days):
    by = [builds.FACT_MONTH, builds.SERIES_PART]
    bad = three_days.read("gold.fact_sales").limit(9)
    bad = bad.withColumns({"store_key": F.lit(-1).cast("long"), "date_key": F.when(F.col("date_key") > 20100301, F.col("date_key"))})
    dims = builds._dimensions(three_days)
    found = builds.quality.checks_of_totals(builds.quality.fact_totals(bad, dims, by), dims, 9)
    want = builds.quality.fact_null_keys(bad).unionByName(builds.quality.fact_orphans(bad, dims))
    assert rows(found.filter("check <> 'fact vs silver count drift'")) == rows(want)
    assert not builds.quality.checks_of_totals(builds.quality.fact_totals(bad, dims, by), dims, 20).filter("check LIKE 'fact%'").first()["passed"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_comparisons_read_the_parts_of_touched_series_only(three_days):
    fact = three_days.read("gold.fact_sales")
    batch = tables.staged(fact.filter(F.col("sales_key") < (2 << 32)).limit(1).drop("sales_vs_ly"))
    part = batch.select(builds._series_part(8)).first()[0]
    plan = plan_of(builds.moved_comparisons(fact, batch, 8))
    filters = [f for f in re.findall(r"PartitionFilters: \[(.*?)\]", plan) if builds.SERIES_PART in f]
    assert filters and all(re.search(rf"{builds.SERIES_PART}#\d+ (=|IN \()\s*{part}", f) for f in filters), plan
    tables.drop_staged(three_days.spark)


def test_marts_follow_from_the_base_without_a_shuffle(spark, three_days):
    from tillwright.plans import marts

    path, stores = three_days.path("platinum.base"), three_days.read("silver.stores")
    base = marts.kept_base(spark, path, builds.MONTH)
    assert base.count() == 120
    for mart in (marts.trend_mart, marts.promotion_mart):
        plan = plan_of(mart(base, stores).select("*"))
        assert "hashpartitioning" not in plan and "rangepartitioning" not in plan, plan


def test_marts_equal_those_of_all_weeks(spark, three_days):
    from tillwright.plans import marts

    sales, features = three_days.read("silver.sales").drop(builds.MONTH), three_days.read("silver.features").drop(builds.MONTH)
    base, stores = marts.weekly_base(sales, features), three_days.read("silver.stores")
    promotion = three_days.read("platinum.promotion").drop(builds.WEEK_MONTH)
    assert rows(promotion) == rows(marts.promotion_mart(base, stores).select(*promotion.columns))
    assert rows(three_days.read("platinum.trend")) == rows(marts.trend_mart(base, stores))


def test_no_staged_table_is_left(three_days, spark):
    staged = f"{spark.conf.get('spark.checkpoint.dir')}/staged"
    mine = tables.staged_count()
    assert mine == 0 and not [p for p in os.listdir(staged) if not p.startswith(".")]


def visible(path):
    return sorted(n for n in os.listdir(path) if not n.startswith("."))


def test_a_cut_off_replace_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3), path)
    open(f"{path}/.v00000002", "w").close()  # a manifest that didn't get its name
    spark.range(9).write.parquet(f"{path}/data/table_write=2")
    assert tables.read_table(spark, path).count() == 3
    tables.replace_table(tables.read_table(spark, path).limit(2), path)
    assert tables.read_table(spark, path).count() == 2
    assert visible(path) == ["data", "v00000001", "v00000003"]
    assert sorted(os.listdir(f"{path}/data")) == ["table_write=1", "table_write=3"]
    tables.replace_table(spark.range(5), path)
    assert visible(path) == ["data", "v00000003", "v00000004"]
    assert sorted(os.listdir(f"{path}/data")) == ["table_write=3", "table_write=4"]


def monthly(spark, amounts):
    return spark.createDataFrame([(k, m, p, v) for (k, m, p), v in amounts.items()], "k int, m int, p string, v int")


def merged(spark, path, amounts):
    tables.merge_table(spark, path, monthly(spark, amounts), ["k", "m"], ["v"], partition_by="m")


def test_a_write_of_several_partitions_takes_effect_in_one_step(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = {(k, m, "a/b"): k * m for k in (1, 2) for m in (1, 2, 3)}
    merged(spark, path, first)
    before = rows(tables.read_table(spark, path))
    assert before == rows(monthly(spark, first))
    # Stopped when all files of two partitions are there, and when only one partition's are.
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            merged(spark, path, {(1, 1, "a/b"): 70, (3, 2, "a/b"): 80})
    assert sorted(p for p in os.listdir(f"{path}/data/table_write=2") if "=" in p) == ["m=1", "m=2"]
    assert rows(tables.read_table(spark, path)) == before
    os.makedirs(f"{path}/data/table_write=3/m=1")
    assert rows(tables.read_table(spark, path)) == before
    # A reader of the version before goes on reading it while partitions are replaced.
    reader = tables.read_table(spark, path)
    merged(spark, path, {(1, 1, "a/b"): 7, (3, 2, "c"): 8})
    after = {**first, (1, 1, "a/b"): 7, (3, 2, "c"): 8}
    assert rows(reader) == before and rows(tables.read_table(spark, path)) == rows(monthly(spark, after))
    parts = tables.current(spark, path).parts
    assert parts == [("m=1", 4), ("m=2", 4), ("m=3", 1)]
    assert sorted(os.listdir(f"{path}/data")) == ["table_write=1", "table_write=4"]
    merged(spark, path, {(1, 1, "a/b"): 9})
    assert sorted(p for p in os.listdir(f"{path}/data/table_write=1") if "=" in p) == ["m=3"]
    tables.drop_staged(spark)


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(monthly(spark, {(k, m, "x"): 1 for k in (1, 2) for m in (1, 2, 3)}), path, ["m", "k"])
    some = tables.read_table(spark, path).filter("m = 2 AND k IN (1, 2)")
    assert rows(some, "m", "k") == [(2, 1), (2, 2)]
    assert scanned(some) == 2
    tables.replace_partitions(some.withColumn("v", F.lit(5)).filter("k = 1"), path, ["m", "k"])
    assert rows(tables.read_table(spark, path).filter("v = 5"), "m", "k") == [(2, 1)]
    assert tables.read_table(spark, path).count() == 6


def scanned(df):
    """Partitions that the scans of a run of ``df`` read."""
    df = df.select("*")
    execution = df._jdf.queryExecution()
    scans = re.findall(r"PartitionFilters: \[(.*?)\]", execution.executedPlan().toString())
    assert any("IN" in s or "=" in s for s in scans), scans
    return len({os.path.dirname(f) for f in df.inputFiles()} & {os.path.dirname(f) for (f,) in df.select(F.input_file_name()).distinct().collect()})


def test_appends_are_joined_at_last(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_APPENDS", 3)
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(1), path)
    for i in range(1, 6):
        tables.append_rows(spark.range(i, i + 1), path)
        assert rows(tables.read_table(spark, path)) == [(j,) for j in range(i + 1)]
    assert len(tables.current(spark, path).parts) == 3
    tables.replace_table(spark.range(0).withColumn("m", F.lit(1)), path, "m")
    assert tables.read_table(spark, path).count() == 0 and tables.exists(spark, path)
    with pytest.raises(ValueError, match="can't have a column"):
        tables.replace_table(spark.range(1).withColumnRenamed("id", "table_write"), path)


def test_unknown_files_are_not_taken_for_no_table(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no table write"):
        tables.exists(spark, str(tmp_path / "t"))


def test_stream_takes_loads_in_any_order(spark, tmp_path):
    root = str(tmp_path / "w")
    warehouse = Warehouse(spark, root)
    loads = [
        ("2011-07-05 05:00:00", 100.0), ("2011-07-05 02:00:00", 50.0),
        ("2011-06-20 01:00:00", 30.0), ("2011-07-05 05:00:00", 99.0),
    ]
    for i, (at, amount) in enumerate(loads):
        other = (1, i + 2, WEEKS[0], amount, False, at)
        append_raw(bronze_sales(spark, [(1, 1, WEEKS[0], amount, False, at), other]), warehouse.path("bronze.sales"))
        stream_sales(spark, warehouse, str(tmp_path / "c")).awaitTermination()
    got = warehouse.read("silver.sales")
    assert rows(got.select("department_id", "weekly_sales", F.col("updated_at").cast("string"))) == [
        (1, Decimal("100.00"), "2011-07-05 05:00:00"), (2, Decimal("100.00"), "2011-07-05 05:00:00"),
        (3, Decimal("50.00"), "2011-07-05 02:00:00"), (4, Decimal("30.00"), "2011-06-20 01:00:00"),
        (5, Decimal("99.00"), "2011-07-05 05:00:00"),
    ]
    whole = silver.loaded_sales(spark.read.parquet(warehouse.path("bronze.sales")))
    same = ["store_id", "department_id", "date", "weekly_sales", "is_holiday"]
    assert rows(got.select(*same)) == rows(whole.select(*same))


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("Size,extra,STORE,Type\n151315,x,1,A\n")
    assert rows(read_csv(spark, str(tmp_path / "stores.csv"), schemas.RAW_STORES)) == [(1, "A", 151315)]
    (tmp_path / "short.csv").write_text("Store,Type\n1,A\n")
    with pytest.raises(ValueError, match="size"):
        read_csv(spark, str(tmp_path / "short.csv"), schemas.RAW_STORES)


def test_csv_rows_that_cannot_be_read(spark, tmp_path):
    source = str(tmp_path / "stores.csv")
    (tmp_path / "stores.csv").write_text("Store,Type,Size\n1,A,10\n2,B,bad\n3,C\n4,A,NA\n5,B,\n")
    with pytest.raises(Exception, match="unreadable row"):
        read_csv(spark, source, schemas.RAW_STORES).collect()
    target, rejects = str(tmp_path / "bronze"), str(tmp_path / "rejects")
    ingest(spark, source, schemas.RAW_STORES, "stores.csv", f"{DAYS[0]} 01:00:00", target, rejects)
    assert rows(spark.read.parquet(target), "store", "size") == [(1, 10), (4, None), (5, None)]
    assert rows(spark.read.parquet(rejects), "store", "size") == [("2", "bad"), ("3", None)]


def test_training_source_is_chosen_by_the_caller(spark, three_days, tmp_path):
    assert training_source(spark, "silver", three_days.root).count() == 120
    with pytest.raises(ValueError, match="source must be"):
        training_source(spark, "auto", three_days.root)
    with pytest.raises(ValueError, match="no table"):
        training_source(spark, "silver", str(tmp_path))


def test_nan_indicators(spark):
    nan = float("nan")
    loaded = bronze_features(
        spark,
        [{"store": 1, "cpi": nan}, {"store": 2, "temperature": nan}, {"store": 3, "unemployment": nan}, {"store": 4}],
    )
    clean = silver.silver_features(loaded, "2010-02-05")
    assert rows(clean, "store_id", "temperature") == [(2, None), (4, Decimal("50.00"))]


def test_keys_refuse_what_does_not_fit(spark):
    from tillwright.operators.keys import sales_key

    for department, day in ((65536, "2010-02-05"), (-1, "2010-02-05"), (1, "1969-12-31"), (1, "2150-01-01")):
        key = sales_key(F.lit(1), F.lit(department), F.lit(day).cast("date"))
        with pytest.raises(Exception, match="key field"):
            spark.range(1).select(key.alias("k")).collect()


def test_a_merge_leaves_nothing_staged(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "k int, part string, v double")
    before = tables.staged_count()
    for some in (batch, batch.withColumn("v", F.col("v") + 1), batch.filter("false")):
        tables.merge_table(spark, str(tmp_path / "t"), some, ["k"], ["v"], partition_by="part")
    assert tables.staged_count() == before
    assert rows(tables.read_table(spark, str(tmp_path / "t"))) == [(1, "a", 3.0), (2, "b", 4.0)]


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    def shuffled():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {n for d in manager.localDirsString() for _, _, names in os.walk(d) for n in names if n.startswith("shuffle_")}

    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffled()
    was = spark.conf.get(key)
    with tables.shuffles_removed(spark):
        spark.range(1000).repartition(3).groupBy("id").count().write.parquet(str(tmp_path / "t"))
    assert spark.conf.get(key) == was and not shuffled() - before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_a_raw_table_of_one_reader_is_not_kept(spark, sf_dir):
    tables_of = registry.Tables(spark, sf_dir)
    path = f"{tables_of.root}/bronze/stores"
    known = registry._DONE.pop(path, None)
    found = tables_of.once("bronze.stores")
    assert path not in registry._DONE and found.count() > 0
    if known:
        registry._DONE[path] = known
