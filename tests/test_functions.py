from decimal import Decimal

import pytest
from helpers import d
from pyspark.sql import functions as F

from tillwright.functions import bands, dates, numeric


def values(spark, expression, inputs, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "rule, inputs, expected",
    [
        (
            lambda c: bands.band(c, *bands.TEMPERATURE_BANDS),
            ["31.99", "32", "49.99", "50", "69.99", "70", "84.99", "85"],
            ["Cold", "Cool", "Cool", "Mild", "Mild", "Warm", "Warm", "Hot"],
        ),
        (
            lambda c: bands.band(c, *bands.FUEL_BANDS),
            ["2.49", "2.5", "3.49", "3.5", "3.99", "4"],
            ["Low", "Medium", "Medium", "High", "High", "Very High"],
        ),
        (
            lambda c: bands.band(c, *bands.CPI_BANDS),
            ["199.99", "200", "219.99", "220"],
            ["Low Inflation", "Moderate Inflation", "Moderate Inflation", "High Inflation"],
        ),
        (
            lambda c: bands.band(c, *bands.UNEMPLOYMENT_BANDS),
            ["4.99", "5", "7.99", "8"],
            ["Low", "Medium", "Medium", "High"],
        ),
        (
            lambda c: bands.band(c, *bands.CONDITION_BANDS),
            ["3.99", "4", "5.99", "6", "7.99", "8"],
            ["Peak", "Growth", "Growth", "Recovery", "Recovery", "Recession"],
        ),
        (
            bands.promotion_type,
            ["0", "0.01", "999.99", "1000", "4999.99", "5000"],
            ["None", "Light", "Light", "Moderate", "Moderate", "Heavy"],
        ),
        (
            lambda c: bands.mixed_band(c, 200, 220, bands.CPI_IMPACT_BANDS),
            ["199.99", "200", "220", "220.01"],
            ["Low(<200)", "Moderate(200-220)", "Moderate(200-220)", "High(>220)"],
        ),
        (
            lambda c: bands.mixed_band(c, 5, 8, bands.UNEMPLOYMENT_IMPACT_BANDS),
            ["4.99", "5", "8", "8.01"],
            ["Low(<5%)", "Medium(5-8%)", "Medium(5-8%)", "High(>8%)"],
        ),
    ],
)
def test_number_bands(spark, rule, inputs, expected):
    assert values(spark, rule, [Decimal(v) for v in inputs], "decimal(12,2)") == expected


def test_size_and_department_bands(spark):
    sizes = values(
        spark, lambda c: bands.band(c, *bands.SIZE_BANDS), [49999, 50000, 99999, 100000, 149999, 150000], "int"
    )
    assert sizes == ["Small", "Medium", "Medium", "Large", "Large", "Extra Large"]
    closed = lambda rule: lambda c: bands.band(c, *rule, right_closed=True)
    edges = [10, 11, 30, 31, 50, 51, 60, 61, 90, 91]
    assert values(spark, closed(bands.DEPARTMENT_GROUPS), edges, "int") == (
        ["Hardlines"] * 3 + ["Softlines"] * 2 + ["Consumables"] * 5
    )
    categories = values(spark, closed(bands.DEPARTMENT_CATEGORIES), edges, "int")
    assert categories[0] == "Electronics & Home" and categories[1] == "Apparel & Accessories"
    assert categories[-2:] == ["Seasonal", "Other"]
    assert values(spark, bands.promotion_intensity, [0, 1, 2, 3, 4, 5], "int") == [
        "None", "Low", "Low", "Medium", "Medium", "High",
    ]


def test_type_codes(spark):
    assert values(spark, bands.store_type_code, ["A", "B", "C", "Z", None], "string") == [0, 1, 2, 0, 0]


def test_band_rejects_bad_rules():
    with pytest.raises(ValueError):
        bands.band(F.lit(1), [1, 2], ["a", "b"])
    with pytest.raises(ValueError):
        bands.band(F.lit(1), [2, 1], ["a", "b", "c"])


def test_calendar(spark):
    days = ["2010-01-01", "2010-01-31", "2010-02-01", "2010-02-10", "2010-11-21", "2010-11-24",
            "2010-11-28", "2010-12-26", "2012-12-31"]
    frame = spark.createDataFrame([(d(x),) for x in days], "full_date date")
    got = {str(r["full_date"]): r for r in dates.with_holidays(dates.with_calendar(frame)).collect()}
    first = got["2010-01-01"]
    assert first["date_key"] == 20100101
    assert (first["week_of_year"], first["year_week"]) == (53, "2010-W53")
    assert (first["month_name"], first["day_name"], first["day_of_week"]) == ("January", "Friday", 5)
    assert (first["fiscal_year"], first["fiscal_quarter"], first["fiscal_period"]) == (2009, 4, 12)
    february = got["2010-02-01"]
    assert (february["fiscal_year"], february["fiscal_quarter"], february["fiscal_period"]) == (2010, 1, 1)
    assert got["2010-01-31"]["is_weekend"] and not got["2010-01-31"]["is_business_day"]
    assert got["2010-02-10"]["holiday_name"] == "Super Bowl" and not got["2010-02-10"]["is_business_day"]
    assert not got["2010-11-21"]["is_holiday"]
    assert (got["2010-11-24"]["holiday_name"], got["2010-11-24"]["event_name"]) == ("Thanksgiving", "Black Friday")
    assert got["2010-11-28"]["is_holiday"] and got["2010-11-28"]["event_name"] is None
    assert (got["2010-12-26"]["holiday_name"], got["2010-12-26"]["event_name"]) == ("Christmas", "Boxing Day")
    assert got["2012-12-31"]["year_week"] == "2012-W01" and got["2012-12-31"]["week_of_month"] == 5


def test_flagged_days_keep_their_names(spark):
    base = dates.with_calendar(spark.createDataFrame([(d("2010-12-26"),)], "full_date date"))
    own = base.withColumns({"is_holiday": F.lit(True), "holiday_name": F.lit("Local")})
    row = dates.with_holidays(own).first()
    assert (row["holiday_name"], row["event_name"]) == ("Local", None)


def test_fixed_calendar(spark):
    from tillwright.plans.gold import dim_date_range

    assert dim_date_range(spark, "2010-01-01", "2020-12-31").count() == 4018


def test_exact_rounding(spark):
    df = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "x decimal(18,2)")
    assert df.agg(numeric.mean2(F.col("x"))).first()[0] == Decimal("0.02")
    one = df.limit(1).select(
        numeric.ratio(F.lit(1), F.lit(0)).alias("r"), numeric.quotient(F.lit(1), F.lit(0)).alias("q")
    )
    assert one.first() == (None, None)
    assert values(spark, numeric.or_zero, [float("nan"), None, 2.5], "double") == [0.0, 0.0, 2.5]
