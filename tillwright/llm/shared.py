"""Helpers of the operators: intermediate tables, and texts as a fixed frame."""

import atexit
import contextlib
import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.sources.shared import shared_folder

_FOLDERS = {}

#: Rows of documents, and bytes of them, that a Python worker gets at once.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20


def run_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one, removed when the driver's
    Python ends. Results read from it, so it must outlive the operators' calls."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = f"{shared_folder(spark)}/llm-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(drop_run_folder, spark)
    return _FOLDERS[app]


def drop_run_folder(spark: SparkSession) -> None:
    """Delete what the operators staged; results not yet read can't be read then."""
    with contextlib.suppress(Exception):  # at exit the session may be gone
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(spark.sparkContext.applicationId))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and kept
    when executors are lost."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give back what a task has freed: its Python worker goes on to other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def drop(df: DataFrame) -> None:
    """Delete a table that ``staged`` wrote and nothing reads any more."""
    for name in df.inputFiles()[:1]:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name).getParent()
        if run_folder(df.sparkSession).split(":")[-1] in path.toString():
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def small_batches(spark: SparkSession) -> None:
    """Small batches for Python workers, for this session from now on: texts are long,
    and a worker's memory follows the batch. A longer text is a batch of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that most operators read; a null text is an empty one.
    Other columns, whatever their names, are left behind."""
    small_batches(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def total_bytes(texts: DataFrame) -> int:
    return texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def blocks_for(texts: DataFrame, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` hold all texts."""
    return max(1, -(-total_bytes(texts) // block_bytes))
