from datetime import timedelta
from decimal import Decimal

from helpers import d, rows, silver_features, silver_sales, silver_stores
from pyspark.sql import functions as F

from tillwright.plans import gold, marts, quality, reports
from tillwright.schemas import INDICATORS, MARKDOWNS

NAN = float("nan")


def star(sales, features, stores):
    promotions, economics = gold.dim_promotion(features), gold.dim_economic(features)
    dates = gold.dim_date_from_facts(sales, features)
    departments = gold.dim_department(sales)
    dim = gold.dim_store(stores)
    fact = gold.fact_sales(sales, dates, dim, departments, gold.feature_keys(features, promotions, economics))
    return fact, dates, dim, departments, promotions, economics


def test_promotion_dimension(spark):
    features = silver_features(
        spark,
        [
            dict(store=1),
            dict(store=2, markdown1=NAN, markdown2=0.0),
            dict(store=3, markdown1=999.99),
            dict(store=4, markdown1=999.99),
            dict(store=5, markdown1=1000.0, markdown2=1.0, markdown3=1.0),
            dict(store=6, **{m: 1000.0 for m in MARKDOWNS}),
            dict(store=7, markdown1=5.0, markdown2=-5.0),
        ],
    )
    dim = gold.dim_promotion(features)
    assert dim.count() == 5
    zero = dim.filter("promotion_key = 0").first()
    assert (zero["promotion_type"], zero["promotion_intensity"], zero["total_markdown"]) == ("None", "None", 0)
    by_total = {r["total_markdown"]: r for r in dim.filter("promotion_key > 0").collect()}
    assert by_total[Decimal("999.99")]["promotion_type"] == "Light"
    assert by_total[Decimal("1002.00")]["promotion_intensity"] == "Medium"
    full = by_total[Decimal("5000.00")]
    assert (full["promotion_type"], full["promotion_intensity"], full["num_markdowns"]) == ("Heavy", "High", 5)
    assert by_total[Decimal("0.00")]["promotion_type"] == "None" and by_total[Decimal("0.00")]["has_markdown1"]
    assert rows(dim, "promotion_key") == [(i,) for i in range(5)]


def test_dimension_keys_never_change(spark):
    first = gold.dim_promotion(silver_features(spark, [dict(store=1, markdown1=50.0)]))
    more = silver_features(spark, [dict(store=1, markdown1=50.0), dict(store=2, markdown1=7.0)])
    grown = gold.dim_promotion(more, first)
    assert rows(grown, "promotion_key", "markdown1") == [
        (0, Decimal("0.00")), (1, Decimal("50.00")), (2, Decimal("7.00")),
    ]
    economics = gold.dim_economic(more)
    assert rows(gold.dim_economic(more, economics)) == rows(economics)


def test_economic_dimension(spark):
    features = silver_features(
        spark, [dict(store=1, temperature=72.31, fuel_price=2.572, cpi=211.0965, unemployment=8.106)]
    )
    dim = gold.dim_economic(features)
    known = dim.filter("economic_key = 1").first()
    assert [known[c] for c in INDICATORS] == [
        Decimal("72.30"), Decimal("2.570"), Decimal("211.097000"), Decimal("8.110"),
    ]
    assert (known["temperature_band"], known["economic_condition"]) == ("Warm", "Recession")
    unknown = dim.filter("economic_key = 0").first()
    assert (unknown["economic_condition"], unknown["cpi"], unknown["cpi_category"]) == ("Unknown", 1, None)


def test_bands_follow_the_rounded_key(spark):
    features = silver_features(
        spark,
        [dict(store=1, unemployment=7.996, temperature=10.0), dict(store=2, unemployment=8.001, temperature=10.0)],
    )
    dim = gold.dim_economic(features).filter("economic_key > 0")
    assert rows(dim, "unemployment_category") == [("High",)]


def test_fact_keys(spark):
    sales = silver_sales(
        spark,
        [
            (1, 1, "2010-02-05", 24924.50, False),
            (1, 2, "2010-02-05", 50605.27, False),
            (1, 1, "2010-02-12", 46039.49, True),
            (9, 1, "2010-02-05", 1.0, False),
        ],
    )
    features = silver_features(spark, [dict(store=1, markdown1=100.0)])
    fact, dates, dim, departments, promotions, economics = star(
        sales, features, silver_stores(spark, [(1, "A", 151315)])
    )
    assert rows(fact, "date_key", "department_key", "promotion_key", "economic_key", "weekly_sales") == [
        (20100205, 1, 1, 1, Decimal("24924.50")),
        (20100205, 2, 1, 1, Decimal("50605.27")),
        (20100212, 1, 0, 0, Decimal("46039.49")),
    ]
    dims = {
        "date_key": dates, "store_key": dim, "department_key": departments,
        "promotion_key": promotions, "economic_key": economics,
    }
    checks = quality.fact_orphans(fact, dims).unionByName(quality.fact_null_keys(fact))
    assert all(r["passed"] for r in checks.collect())
    drift = quality.count_drift(fact, sales).first()
    assert drift["value"] == 1 and not drift["passed"]


def test_orphans_are_found(spark):
    fact = spark.createDataFrame([(1, 7), (1, 8), (2, 7)], "date_key int, store_key int")
    dims = {"date_key": spark.createDataFrame([(1,)], "date_key int"), "store_key": fact.select("store_key")}
    found = rows(quality.fact_orphans(fact, dims), "check", "value", "passed")
    assert found == [("orphan date_key", 1.0, False), ("orphan store_key", 0.0, True)]


def weekly(amounts, skip=()):
    start = d("2010-02-05")
    return [
        (1, 1, str(start + timedelta(weeks=i)), a, False) for i, a in enumerate(amounts) if i not in skip
    ]


def yoy(spark, records, mode):
    sales = silver_sales(spark, records)
    fact = star(sales, silver_features(spark, [dict()]), silver_stores(spark, [(1, "A", 10)]))[0]
    result = gold.fact_yoy(fact, mode).orderBy("date_key")
    return [(r["sales_vs_ly"], r["sales_growth_pct"]) for r in result.collect()]


def test_year_over_year(spark):
    amounts = [100.0, 0.0, -5.0, 0.01, 300.0] + [1.0] * 47 + [150.0, 5.0, 5.0, 99999.0, 100.0]
    got = yoy(spark, weekly(amounts), "rows")
    assert got[:52] == [(None, None)] * 52
    assert got[52:] == [
        (Decimal("100.00"), Decimal("50.00")),
        (Decimal("0.00"), None),
        (Decimal("-5.00"), None),
        (Decimal("0.01"), Decimal("999.99")),
        (Decimal("300.00"), Decimal("-66.67")),
    ]


def test_year_over_year_over_a_gap(spark):
    amounts = [10.0, 20.0] + [1.0] * 50 + [30.0, 40.0]
    by_rows = yoy(spark, weekly(amounts, skip={5}), "rows")
    assert by_rows[-1][0] == Decimal("10.00")  # 52 rows back, one week too far
    by_calendar = yoy(spark, weekly(amounts, skip={5}), "calendar")
    assert [v for v, _ in by_calendar[-2:]] == [Decimal("10.00"), Decimal("20.00")]


def test_marts(spark):
    sales = silver_sales(
        spark,
        [(1, 1, "2010-02-05", 100.0, False), (1, 1, "2010-02-12", 50.0, True), (1, 2, "2010-02-05", -20.0, False)],
    )
    features = silver_features(spark, [dict(store=1, markdown1=20.0, markdown3=NAN)])
    stores = silver_stores(spark, [(1, "B", 60000)])
    base = marts.weekly_base(sales, features)
    promo = {(r["department_id"], str(r["week_start"])): r for r in marts.promotion_mart(base, stores).collect()}
    first = promo[(1, "2010-02-01")]
    assert (first["avg_markdown1"], first["has_markdown1"], first["promotion_roi"]) == (20.0, True, 5.0)
    second = promo[(1, "2010-02-08")]
    assert (second["avg_markdown1"], second["has_markdown1"], second["promotion_roi"]) == (0.0, False, None)
    assert second["has_holiday"] == 1 and second["store_type"] == "B"
    trend = marts.trend_mart(base, stores)
    growth = marts.trend_growth(trend).filter("department_id = 1").orderBy("week_start").collect()
    assert [r["wow_growth_pct"] for r in growth] == [None, Decimal("-50.00")]


def test_week_over_a_month_end_keeps_its_order(spark):
    sales = silver_sales(
        spark,
        [(1, 1, "2010-03-31", 1.0, False), (1, 1, "2010-04-02", 2.0, False), (1, 1, "2010-04-09", 4.0, False)],
    )
    base = marts.weekly_base(sales, silver_features(spark, [dict()]))
    trend = marts.trend_mart(base, silver_stores(spark, [(1, "A", 1)])).orderBy("week_start", "month_start")
    assert [r["sales_1w_ago"] for r in trend.collect()] == [None, Decimal("1.00"), Decimal("2.00")]


def test_reports_on_edges(spark):
    sales = silver_sales(spark, [(1, 1, "2010-02-05", 0.01, False), (1, 2, "2010-02-05", 0.02, False)])
    features = silver_features(spark, [dict(store=1, markdown1=-3.0)])
    stores = silver_stores(spark, [(1, "A", 1)])
    kpi = reports.kpi_summary(sales).first()
    assert kpi["avg_weekly_sales"] == Decimal("0.02")
    assert (kpi["avg_holiday_sales"], kpi["holiday_lift_pct"]) == (None, None)
    assert reports.compare_stores(sales, stores, 1, 2).count() == 0
    ranking = {r["markdown_type"]: r for r in reports.markdown_ranking(sales, stores, features).collect()}
    negative = ranking["MarkDown1"]
    assert (negative["weeks_active"], negative["avg_sales_without_markdown"]) == (0, 0)
    assert ranking["MarkDown2"]["avg_sales_lift_pct"] == Decimal("-2.00")
    only = reports.promotion_effectiveness(sales, stores, features, store_id=1).first()
    assert only["total_md1"] == Decimal("-6.00")
    assert reports.promotion_effectiveness(sales, stores, features, store_type="B").count() == 0


def test_quality_finds_faults(spark):
    stores = silver_stores(spark, [(1, "A", 1)])
    broken = stores.unionByName(stores.withColumn("version", F.lit(3)))
    failed = {r["check"] for r in quality.scd2_invariants(broken).collect() if not r["passed"]}
    assert "stores without exactly one current version" in failed
    assert "stores with missing version numbers" in failed
    twice = quality.duplicate_keys(stores.unionByName(stores), ["store_id"], "stores").first()
    assert twice["value"] == 1 and not twice["passed"]
    try:
        quality.require(quality.scd2_invariants(broken))
    except ValueError as error:
        assert "current version" in str(error)
    else:
        raise AssertionError("a failed check must raise")
