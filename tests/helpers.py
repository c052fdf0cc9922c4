"""Small frames and comparison helpers."""

import math
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from tillwright import schemas
from tillwright.sources.files import with_audit


def d(text):
    return date.fromisoformat(text)


def rows(df, *columns):
    """Sorted tuples of a frame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])


def norm(value):
    if value is None or isinstance(value, (bool, str)):
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def bronze_sales(spark, records):
    """records: (store, dept, date, weekly_sales, isholiday, load time)."""
    schema = "store int, dept int, date date, weekly_sales double, isholiday boolean, _at timestamp"
    data = [(s, p, d(day), v, h, datetime.fromisoformat(at)) for s, p, day, v, h, at in records]
    return with_audit(spark.createDataFrame(data, schema), "train.csv", F.col("_at"))


def bronze_features(spark, records):
    """records: dictionaries over the raw feature columns, plus ``at``."""
    names = [f.name for f in schemas.RAW_FEATURES.fields]
    defaults = {"store": 1, "date": d("2010-02-05"), "temperature": 50.0, "fuel_price": 3.0,
                "cpi": 210.0, "unemployment": 8.0, "isholiday": False}
    data = []
    for record in records:
        full = {**dict.fromkeys(names), **defaults, **record}
        at = datetime.fromisoformat(record.get("at", "2010-02-05 01:00:00"))
        data.append(tuple(full[n] for n in names) + (at,))
    schema = StructType([*schemas.RAW_FEATURES.fields, StructField("_at", TimestampType())])
    return with_audit(spark.createDataFrame(data, schema), "features.csv", F.col("_at"))


def bronze_stores(spark, records):
    """records: (store, type, size, load time)."""
    data = [(s, t, z, datetime.fromisoformat(at)) for s, t, z, at in records]
    schema = "store int, type string, size int, _at timestamp"
    return with_audit(spark.createDataFrame(data, schema), "stores.csv", F.col("_at"))


def silver_sales(spark, records):
    """records: (store, department, date, amount, holiday)."""
    from tillwright.plans.silver import silver_sales as clean

    loaded = [(s, p, day, float(v), h, "2010-02-05 01:00:00") for s, p, day, v, h in records]
    return clean(bronze_sales(spark, loaded), "2010-02-05")


def silver_features(spark, records):
    from tillwright.plans.silver import silver_features as clean

    return clean(bronze_features(spark, records), "2010-02-05")


def silver_stores(spark, records):
    from tillwright.plans.silver import silver_stores as clean

    loaded = [(s, t, z, "2010-02-05 01:00:00") for s, t, z in records]
    return clean(bronze_stores(spark, loaded), None, "2010-02-05")
