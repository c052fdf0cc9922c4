"""Session settings the operators are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Dates and load times mean the same everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Join strategies and partition sizes follow measured sizes; hot keys of a
    # join are split. The last setting allows that where it costs a shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Overflow and bad casts fail instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
}


def build_session(
    master: str | None = None, name: str = "tillwright", conf: dict | None = None
) -> SparkSession:
    """A session with the settings above, and those of ``conf`` over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
