"""Calendar attributes and holiday rules, as column expressions over a date."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month, first day, last day, name.
HOLIDAYS = [
    (2, 10, 14, "Super Bowl"),
    (9, 8, 12, "Labor Day"),
    (11, 22, 28, "Thanksgiving"),
    (12, 24, 31, "Christmas"),
]
EVENTS = [(11, 24, 26, "Black Friday"), (12, 26, 26, "Boxing Day")]


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic (no text round trip)."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_day(day: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(day) + 1


def _within(day: Column, month: int, first: int, last: int) -> Column:
    return (F.month(day) == month) & F.dayofmonth(day).between(first, last)


def _named(day: Column, windows) -> Column:
    name = F
    for month, first, last, label in windows:
        name = name.when(_within(day, month, first, last), label)
    return name


def in_holiday_window(day: Column) -> Column:
    return reduce(or_, [_within(day, *window[:3]) for window in HOLIDAYS])


def holiday_name(day: Column) -> Column:
    return _named(day, HOLIDAYS)


def event_name(day: Column) -> Column:
    return _named(day, EVENTS)


def fiscal_year(day: Column) -> Column:
    """Fiscal years start in February."""
    return F.year(day) - F.when(F.month(day) < 2, 1).otherwise(0)


def fiscal_period(day: Column) -> Column:
    return (F.month(day) + 10) % 12 + 1


def fiscal_quarter(day: Column) -> Column:
    return F.ceil(fiscal_period(day) / 3).cast("int")


def with_calendar(days: DataFrame, day: str = "full_date") -> DataFrame:
    """All calendar columns of one row per ``day``, holiday columns unset."""
    d = F.col(day)
    year_text = F.year(d).cast("string")
    quarter = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    week_text = F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.concat_ws("-", year_text, quarter).alias("year_quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(year_text, F.lit("-W"), week_text).alias("year_week"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        F.quarter(d).alias("quarter_number"),
        quarter.alias("quarter_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.ceil(F.dayofmonth(d) / 7).cast("int").alias("week_of_month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        iso_day(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_abbr"),
        (iso_day(d) >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
        F.lit(True).alias("is_business_day"),
        fiscal_year(d).alias("fiscal_year"),
        fiscal_quarter(d).alias("fiscal_quarter"),
        fiscal_period(d).alias("fiscal_period"),
        F.lit(None).cast("string").alias("event_name"),
    )


def with_holidays(calendar: DataFrame, day: str = "full_date") -> DataFrame:
    """Set holiday, event and business-day columns of a calendar.

    Rows already flagged keep their flag and names; events are named only
    inside a holiday window.
    """
    d = F.col(day)
    newly = ~F.col("is_holiday") & in_holiday_window(d)
    flagged = F.col("is_holiday") | in_holiday_window(d)
    return calendar.withColumns(
        {
            "holiday_name": F.when(newly, holiday_name(d)).otherwise(F.col("holiday_name")),
            "event_name": F.when(newly, event_name(d)).otherwise(F.col("event_name")),
            "is_holiday": flagged,
            "is_business_day": ~(F.col("is_weekend") | flagged),
        }
    )
