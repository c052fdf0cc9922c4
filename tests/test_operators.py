import os
import random
from decimal import Decimal
from glob import glob

import numpy as np
from helpers import d, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwright.operators.keys import extend_keys, global_rank, sales_key, store_version_key, surrogate_key
from tillwright.operators.latest import latest_per_key
from tillwright.operators.lookup import as_of_dimension
from tillwright.operators.medians import exact_medians
from tillwright.operators.merge import insert_absent, upsert
from tillwright.operators.scd2 import scd2_apply, scd2_from_history
from tillwright.plans.quality import scd2_invariants
from tillwright.plans.silver import no_stores
from tillwright.sources.tables import drop_staged

FEW = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
TARGET = "k int, v string, made string, touched string"


def test_upsert(spark):
    target = spark.createDataFrame(
        [(1, "a", "t0", "t0"), (2, "b", "t0", "t0"), (3, "c", "t0", "t0")], TARGET
    )
    batch = spark.createDataFrame(
        [(2, "B", "t1", "t1"), (3, "c", "t1", "t1"), (4, None, "t1", "t1")], TARGET
    )
    merged = upsert(target, batch, ["k"], ["v"], ["touched"])
    assert rows(merged) == [
        (1, "a", "t0", "t0"),
        (2, "B", "t0", "t1"),
        (3, "c", "t0", "t0"),
        (4, None, "t1", "t1"),
    ]


def test_upsert_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, "a", "t0", "t0")], TARGET)
    batch = spark.createDataFrame([(1, None, "t1", "t1")], TARGET)
    assert rows(upsert(target, batch, ["k"], ["v"], ["touched"])) == [(1, None, "t0", "t1")]


pairs = st.dictionaries(st.integers(0, 9), st.sampled_from("abc"), max_size=8)


@FEW
@given(before=pairs, after=pairs)
def test_upsert_is_dict_update_and_idempotent(spark, before, after):
    frame = lambda values, t: spark.createDataFrame([(k, v, t, t) for k, v in values.items()], TARGET)
    once = upsert(frame(before, "0"), frame(after, "1"), ["k"], ["v"], ["touched"])
    assert dict(rows(once, "k", "v")) == {**before, **after}
    twice = upsert(once, frame(after, "2"), ["k"], ["v"], ["touched"])
    assert rows(twice) == rows(once)


def test_insert_absent(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert rows(insert_absent(target, batch, ["k"])) == [(1, "a"), (2, "y")]


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 9)), min_size=1))
def test_latest_per_key_ignores_input_order(spark, records):
    order = [F.desc("t"), F.desc("v")]
    expected = {}
    for k, t, v in records:
        expected[k] = max(expected.get(k, (t, v)), (t, v))
    for seed in (1, 2):
        shuffled = random.Random(seed).sample(records, len(records))
        df = spark.createDataFrame(shuffled, "k int, t int, v int").repartition(3)
        assert rows(latest_per_key(df, ["k"], order)) == sorted((k, *tv) for k, tv in expected.items())


def history(spark, loads):
    """Apply (day, {store: (type, size)}) loads in order."""
    current = no_stores(spark)
    for day, snapshot in loads:
        batch = spark.createDataFrame(
            [(s, t, z) for s, (t, z) in snapshot.items()], "store_id int, store_type string, store_size int"
        )
        # Cut the plan: it would otherwise grow with every load.
        applied = scd2_apply(current, batch, "store_id", ["store_type", "store_size"], day)
        current = spark.createDataFrame(applied.collect(), applied.schema)
    return current


def test_scd2_golden(spark):
    end = d("9999-12-31")
    result = history(
        spark,
        [
            ("2010-02-05", {1: ("A", 151315), 2: ("A", 202307)}),
            ("2011-07-01", {1: ("A", 180000), 2: ("A", 202307), 3: ("B", 37392)}),
        ],
    )
    assert rows(result) == [
        (1, "A", 151315, d("2010-02-05"), d("2011-06-30"), False, 1),
        (1, "A", 180000, d("2011-07-01"), end, True, 2),
        (2, "A", 202307, d("2010-02-05"), end, True, 1),
        (3, "B", 37392, d("2011-07-01"), end, True, 1),
    ]


def test_scd2_same_day_and_repeat(spark):
    loads = [("2010-02-05", {1: ("A", 1)}), ("2010-03-05", {1: ("B", 1)}), ("2010-03-05", {1: ("C", 1)})]
    once = rows(history(spark, loads))
    assert [r[1] for r in once] == ["A", "C"]
    assert rows(history(spark, loads + loads[-1:])) == once


states = st.tuples(st.sampled_from("ABC"), st.integers(1, 2))


@FEW
@given(st.lists(st.dictionaries(st.integers(1, 3), states, min_size=1), min_size=1, max_size=4))
def test_scd2_invariants_and_history_agree(spark, snapshots):
    loads = [(f"2010-0{i + 1}-01", s) for i, s in enumerate(snapshots)]
    applied = history(spark, loads)
    assert all(r["passed"] for r in scd2_invariants(applied).collect())
    dated = spark.createDataFrame(
        [(s, t, z, d(day)) for day, snap in loads for s, (t, z) in snap.items()],
        "store_id int, store_type string, store_size int, day date",
    )
    rebuilt = scd2_from_history(dated, "store_id", ["store_type", "store_size"], "day")
    assert rows(rebuilt, *applied.columns) == rows(applied)


def test_surrogate_key_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("n")).repartition(7)
    got = surrogate_key(df, ["n"], "key").orderBy("n").collect()
    assert [r["key"] for r in got] == list(range(1, 5001))
    known = surrogate_key(df, ["n"], "key")
    more = spark.createDataFrame([(-5,), (9000,)], "n long")
    assert rows(extend_keys(known, more, ["n"], "key")) == [(5001, -5), (5002, 9000)]


def test_keys_run_their_input_once_and_leave_nothing(spark):
    drop_staged(spark)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/staged"
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    df = spark.range(3000).mapInPandas(count, "id long").repartition(5)
    keyed = surrogate_key(df, ["id"], "key")
    assert rows(keyed, "key", "id") == [(i + 1, i) for i in range(3000)] and rows(keyed, "key") == rows(keyed, "key")
    assert runs.value == 3000
    assert glob(f"{spark.conf.get('spark.checkpoint.dir')}/*/rdd-*") == []
    assert len(visible(folder)) == 1  # what the result reads
    drop_staged(spark)
    assert visible(folder) == []


def visible(folder):
    return [n for n in os.listdir(folder) if not n.startswith(".")]


def test_global_rank_equals_a_window(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 13 > 0, (F.col("id") * 7919 % 211).cast("double")).alias("v")).repartition(6)
    more = df.unionByName(spark.range(3000).select(F.col("id") + 9000, F.lit(100.0).alias("v")).toDF("id", "v"))
    want = more.filter("v IS NOT NULL").withColumn("r", F.rank().over(Window.orderBy(F.desc("v")))).unionByName(
        more.filter("v IS NULL").withColumn("r", F.lit(None).cast("int"))
    )
    assert rows(global_rank(more, "v", "r")) == rows(want)
    assert global_rank(df.filter("false"), "v", "r").count() == 0
    drop_staged(spark)


def test_computed_keys_are_unique(spark):
    df = spark.createDataFrame(
        [(s, p, d(day)) for s in (1, 2, 2**31 - 1) for p in (1, 99, 65535) for day in ("1970-01-01", "2100-01-01")],
        "s int, p int, day date",
    )
    keys = df.select(sales_key(F.col("s"), F.col("p"), F.col("day")).alias("k")).distinct()
    assert keys.count() == df.count() and keys.filter("k < 0").count() == 0
    versions = df.select(store_version_key(F.col("s"), F.col("p")).alias("k")).distinct()
    assert versions.count() == 9


def test_as_of_dimension(spark):
    dim = spark.createDataFrame(
        [(1, "old", d("2010-01-01"), d("2010-06-30")), (1, "new", d("2010-07-01"), d("9999-12-31"))],
        "store_id int, name string, effective_date date, end_date date",
    )
    fact = spark.createDataFrame(
        [(1, d("2010-06-30")), (1, d("2010-07-01")), (1, d("2009-12-31")), (2, d("2010-07-01"))],
        "store_id int, day date",
    )
    got = rows(as_of_dimension(fact, dim, "store_id", "day"), "day", "name")
    assert got == [(d("2010-06-30"), "old"), (d("2010-07-01"), "new")]


def test_exact_medians(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=2001)
    b = rng.integers(0, 3, size=2001).astype(float)
    data = [(float(x), float(y), None, Decimal(int(w))) for x, y, w in zip(a, b, rng.integers(1, 4, size=2001))]
    data.append((float("nan"), None, None, Decimal(1)))
    df = spark.createDataFrame(data, "a double, b double, empty double, w decimal(5,0)").withColumn(
        "w", F.col("w").cast("long")
    )
    plain = exact_medians(df, ["a", "b", "empty"])
    assert plain == {"a": float(np.median(a)), "b": float(np.median(b)), "empty": None}
    weights = [int(r[3]) for r in data[:-1]]
    assert exact_medians(df, ["a"], "w")["a"] == float(np.median(np.repeat(a, weights)))
    even = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (100.0,)], "x double")
    assert exact_medians(even, ["x"]) == {"x": 3.0}
