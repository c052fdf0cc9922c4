import os
from decimal import Decimal

from helpers import bronze_features, bronze_sales, bronze_stores, d, rows, silver_features
from pyspark.sql import functions as F

from tillwright import schemas
from tillwright.plans import silver
from tillwright.sources.files import ingest, read_csv

NAN = float("nan")
DAY = "2010-02-05"


def test_csv_sources(spark, tmp_path):
    (tmp_path / "stores.csv").write_bytes(b"Store,Type,Size\r1,A,151315\r2,A,202307\r3,B,37392")
    (tmp_path / "features.csv").write_text(
        "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday\n"
        "1,2010-02-05,42.31,2.572,NA,NA,NA,NA,NA,211.0965,8.106,FALSE\n"
        "1,2010-02-12,38.51,2.548,,10.5,NaN,NA,NA,211.2422,8.106,TRUE\n"
    )
    stores = read_csv(spark, str(tmp_path / "stores.csv"), schemas.RAW_STORES)
    assert rows(stores) == [(1, "A", 151315), (2, "A", 202307), (3, "B", 37392)]
    features = read_csv(spark, str(tmp_path / "features.csv"), schemas.RAW_FEATURES).collect()
    assert (features[0]["markdown1"], features[0]["isholiday"], features[0]["cpi"]) == (None, False, 211.0965)
    assert features[1]["markdown2"] == 10.5 and features[1]["markdown3"] != features[1]["markdown3"]


def test_ingest_appends_with_audit(spark, tmp_path):
    source, target = tmp_path / "stores.csv", str(tmp_path / "bronze")
    source.write_text("Store,Type,Size\n1,A,10\n")
    for at in ("2010-02-05 01:00:00", "2010-02-06 01:00:00"):
        ingest(spark, str(source), schemas.RAW_STORES, "stores.csv", at, target)
    loaded = spark.read.parquet(target)
    assert loaded.count() == 2
    assert loaded.select("row_hash").distinct().count() == 1
    assert sorted(p for p in os.listdir(target) if "=" in p) == [
        "ingest_date=2010-02-05", "ingest_date=2010-02-06",
    ]
    plan = silver.recent(loaded, "2010-02-06", 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_sales_golden_and_rules(spark):
    raw = bronze_sales(
        spark,
        [
            (1, 1, "2010-02-05", 24924.50, False, "2010-02-05 01:00:00"),
            (1, 1, "2010-02-12", 46039.49, True, "2010-02-05 01:00:00"),
            (1, 1, "2010-02-12", 50000.00, True, "2010-02-05 02:00:00"),  # later load wins
            (1, 1, "2010-02-12", None, True, "2010-02-05 03:00:00"),  # no amount
            (1, 2, "2010-02-05", 10.0, False, "2010-02-05 01:00:00"),  # tie: higher amount
            (1, 2, "2010-02-05", 20.0, False, "2010-02-05 01:00:00"),
            (1, 3, "2010-02-05", -798.0, False, "2010-02-04 00:00:00"),  # within one day, negative
            (1, 4, "2010-02-05", 5.0, False, "2010-02-03 23:59:59"),  # before the lookback
            (1, 5, "2010-02-05", 5.0, False, "2010-02-06 00:00:00"),  # a later day's load
        ],
    )
    got = rows(silver.silver_sales(raw, DAY), "store_id", "department_id", "date", "weekly_sales", "is_holiday")
    assert got == [
        (1, 1, d("2010-02-05"), Decimal("24924.50"), False),
        (1, 1, d("2010-02-12"), Decimal("50000.00"), True),
        (1, 2, d("2010-02-05"), Decimal("20.00"), False),
        (1, 3, d("2010-02-05"), Decimal("-798.00"), False),
    ]


def test_features_golden(spark):
    raw = bronze_features(
        spark,
        [
            dict(temperature=42.31, fuel_price=2.572, markdown1=NAN, cpi=211.0965, unemployment=8.106),
            dict(date=d("2010-02-12"), temperature=38.51, fuel_price=2.548, cpi=211.2422, unemployment=8.106, isholiday=True),
        ],
    )
    first = silver.silver_features(raw, DAY).orderBy("date").first()
    assert first["temperature"] == Decimal("42.31") and first["fuel_price"] == Decimal("2.572")
    assert first["cpi"] == Decimal("211.096500") and first["unemployment"] == Decimal("8.106")
    assert [first[m] for m in schemas.MARKDOWNS] == [Decimal("0.00")] * 5


def test_feature_rules(spark):
    raw = bronze_features(
        spark,
        [
            dict(store=1, cpi=0.0),
            dict(store=2, cpi=None),
            dict(store=3, unemployment=100.0),
            dict(store=4, unemployment=100.01),
            dict(store=5, unemployment=NAN),
            dict(store=6, unemployment=None),
            dict(store=7, unemployment=-0.01),
            dict(store=8, fuel_price=-1.0, temperature=None),
            dict(store=9, fuel_price=None),
            dict(store=10, markdown2=-5.25, markdown3=NAN),
            dict(store=11, unemployment=0.0),
        ],
    )
    got = {r["store_id"]: r for r in silver.silver_features(raw, DAY).collect()}
    assert sorted(got) == [3, 8, 9, 10, 11]
    assert got[8]["fuel_price"] == 0 and got[8]["temperature"] is None
    assert got[9]["fuel_price"] == 0
    assert got[10]["markdown2"] == Decimal("-5.25") and got[10]["markdown3"] == 0


def test_latest_feature_load_wins(spark):
    raw = bronze_features(
        spark,
        [
            dict(temperature=1.0, at="2010-02-05 02:00:00"),
            dict(temperature=2.0, at="2010-02-05 03:00:00"),
            dict(temperature=3.0, at="2010-02-05 01:00:00"),
        ],
    )
    assert rows(silver.silver_features(raw, DAY), "temperature") == [(Decimal("2.00"),)]


def test_store_rules(spark):
    raw = bronze_stores(
        spark,
        [
            (1, "A", 151315, "2010-02-05 01:00:00"),
            (2, "D", 1000, "2010-02-05 01:00:00"),
            (3, "B", 0, "2010-02-05 01:00:00"),
            (4, None, 10, "2010-02-05 01:00:00"),
        ],
    )
    stores = silver.silver_stores(raw, None, DAY)
    assert rows(stores, "store_id", "version", "is_current", "end_date") == [(1, 1, True, d("9999-12-31"))]


def test_silver_helper_roundtrip(spark):
    assert silver_features(spark, [dict(store=3)]).select(F.sum("markdown1")).first()[0] == 0
