"""CSV sources and the append-only raw layer."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tillwright.sources.tables import COMPRESSION

_CORRUPT = "_corrupt_record"


def _read_text_fields(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of ``schema`` as text, matched by header name in any letter
    case and order, with the whole line of a row that has too many or few fields."""
    reader = spark.read.option("header", True).option("nullValue", "NA")
    header = reader.csv(path).columns
    places = {name.strip().lower(): i for i, name in enumerate(header)}
    if len(places) < len(header):
        raise ValueError(f"{path} repeats a column: {header}")
    missing = [f.name for f in schema.fields if f.name not in places]
    if missing:
        raise ValueError(f"{path} has no column {missing}, only {header}")
    text = StructType([StructField(n, StringType()) for n in [*header, _CORRUPT]])
    # Every file of a folder must have this header: the reader compares them.
    lines = (
        reader.schema(text)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    fields = [F.col(f"`{header[places[f.name]]}`").alias(f.name) for f in schema.fields]
    return lines.select(*fields, _CORRUPT)


def _typed(field: StructField) -> Column:
    text = F.nullif(F.trim(F.col(field.name)), F.lit(""))
    return text.try_cast(field.dataType).alias(field.name)


def _unreadable(schema: StructType) -> Column:
    """Whether a row has too many or few fields, or one that its type can't hold."""
    found = F.col(_CORRUPT).isNotNull()
    for field in schema.fields:
        present = F.trim(F.col(field.name)) != ""
        found = found | (F.coalesce(present, F.lit(False)) & _typed(field).isNull())
    return found


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A headed CSV file or folder; ``NA`` and empty fields are NULL.

    The reader splits large files by itself, so there is no chunk size. Columns
    are matched by name, the header's letter case ignored, and come in the
    schema's order; others are left out. A row that cannot be read stops the
    job; ``read_csv_rows`` and ``rejected_rows`` keep such rows apart.
    """
    lines = _read_text_fields(spark, path, schema)
    stop = F.raise_error(F.concat(F.lit(f"unreadable row in {path}: "), F.to_json(F.struct("*"))))
    checked = lines.withColumn("_ok", F.when(_unreadable(schema), stop.cast("boolean")).otherwise(True))
    return checked.filter("_ok").select(*[_typed(f) for f in schema.fields])


def read_csv_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The readable rows of a CSV source."""
    lines = _read_text_fields(spark, path, schema)
    return lines.filter(~_unreadable(schema)).select(*[_typed(f) for f in schema.fields])


def rejected_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows ``read_csv_rows`` leaves out, as text, with the whole line where
    it has too many or few fields."""
    return _read_text_fields(spark, path, schema).filter(_unreadable(schema))


def _as_text(column: Column, kind) -> Column:
    text = column.cast("string")
    if isinstance(kind, BooleanType):
        text = F.when(column, "true").when(~column, "false")
    return F.coalesce(text, F.lit(""))


def with_audit(df: DataFrame, source_file: str, ingested_at: Column) -> DataFrame:
    """Add load time, file name and a hash of the source columns.

    The hash covers the source columns only, so equal rows of different loads
    hash alike. A NULL field hashes as an empty one. Columns whose name starts
    with an underscore are working columns and are dropped.
    """
    source = [f for f in df.schema.fields if not f.name.startswith("_")]
    fields = [_as_text(F.col(f.name), f.dataType) for f in source]
    return df.select(
        *[f.name for f in source],
        ingested_at.alias("ingestion_timestamp"),
        F.lit(source_file).alias("source_file"),
        F.md5(F.concat_ws("|", *fields)).alias("row_hash"),
    )


def append_raw(df: DataFrame, path: str) -> None:
    """Append audited rows, partitioned by load day. Each task writes one file
    per load day it holds, and a batch holds one."""
    days = df.withColumn("ingest_date", F.to_date("ingestion_timestamp"))
    days.write.mode("append").option("compression", COMPRESSION).partitionBy("ingest_date").parquet(path)


def ingest(
    spark: SparkSession,
    path: str,
    schema: StructType,
    source_file: str,
    ingested_at,
    target: str,
    rejects: str | None = None,
) -> None:
    """Read a CSV source, add audit columns, append to the raw table. Rows that
    cannot be read are appended to ``rejects`` as text, or without it stop the job
    before anything is appended."""
    stamp = F.lit(ingested_at).cast("timestamp")
    if rejects is None:
        append_raw(with_audit(read_csv(spark, path, schema), source_file, stamp), target)
        return
    refused = rejected_rows(spark, path, schema).withColumns(
        {"ingestion_timestamp": stamp, "source_file": F.lit(source_file)}
    )
    append_raw(refused, rejects)
    append_raw(with_audit(read_csv_rows(spark, path, schema), source_file, stamp), target)
