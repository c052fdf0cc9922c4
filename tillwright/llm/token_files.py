"""Token ids as Parquet files from which single columns and rows can be read.

The file format, version 1. A folder of Parquet files in ascending order of
doc_id and part, one row per document, with the columns

* doc_id long, part int, row long: the document, and its place in the folder
  (part is the number of the file, row counts from 0 within it);
* first long: tokens of the same part before the document;
* n_tokens int: with the end token;
* ids array<int>: the tokens, dictionary encoded; a vocabulary of up to 64 Ki
  ids takes at most two bytes an id.

The numeric columns are delta encoded, so that they stay small, and every row
group has a page index: a reader that wants lengths, or the rows of a few
documents, skips the pages of all other ids.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.shared import blocks_for, id_and_text, release_memory, staged
from tillwright.llm.words import ChunkIds, Words, by_bytes

#: Bytes of text that one file covers on average.
FILE_BYTES = 64 << 20
#: Bytes of a row group and of a page before compression.
ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 256 << 10
#: Characters of texts encoded at once, and bytes of ids after which freed memory is given back.
SLICE_CHARS, RELEASE_BYTES = 2 << 20, 16 << 20
#: Files whose lengths are added up as one group.
GROUP_FILES = 4096

_ROWS = "doc_id long, part int, row long, first long, n_tokens int, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches):
        words = Words(path)
        ids_of = ChunkIds(words)
        part, row, first, done = TaskContext.get().partitionId(), 0, 0, 0
        for batch, texts in _slices(batches):
            ids, ends = ids_of.flat(texts)
            counts = np.diff(ends, prepend=0) + 1
            values = np.insert(ids, ends, end_id).astype(np.int32, copy=False)
            done += values.nbytes
            if done > RELEASE_BYTES:
                release_memory()
                done = 0
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(np.arange(row, row + len(counts))),
                    pa.array(first + ends - counts),
                    pa.array(counts.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(values)),
                ],
                names=["doc_id", "part", "row", "first", "n_tokens", "ids"],
            )
            row, first = row + len(counts), first + int(counts.sum())
        ids_of.forget()
        del words
        release_memory()

    return run


def _slices(batches):
    """(rows, texts) of about ``SLICE_CHARS``: ids take more memory than text."""
    for batch in batches:
        at = 0
        for texts in by_bytes(batch.column("text").to_pylist(), SLICE_CHARS):
            yield batch.slice(at, len(texts)), texts
            at += len(texts)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, file_bytes: int = FILE_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write them to ``folder`` in the format above.

    A null or empty text is the end token alone. Rows of equal doc_id follow each
    other, ordered by text; null ids come first. An empty table gives a folder
    without rows. Other columns aren't read.
    """
    texts = id_and_text(docs)
    files = blocks_for(texts, file_bytes)
    ordered = texts.repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    (
        ordered.mapInArrow(_encode(path, end_id), _ROWS)
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.writer.version", "v2")  # delta encoding where there is no dictionary
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("compression", "zstd")
        .parquet(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids.

    The lengths of the files are added up first, in groups of ``GROUP_FILES``: each
    group's sum, the groups before it, and the files before a file in its group. A
    token's place in the whole corpus is then a sum of three numbers.
    """
    rows = spark.read.schema(_ROWS).parquet(folder)
    lengths = rows.groupBy("part").agg(F.sum(F.col("n_tokens").cast("long")).alias("length"))
    lengths = lengths.withColumn("group", F.floor(F.col("part") / GROUP_FILES))
    groups = lengths.groupBy("group").agg(F.sum("length").alias("length"))
    # One row for each GROUP_FILES files: 256 GB of text.
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("groups_before"))
    inside = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        lengths.withColumn("files_before", F.coalesce(F.sum("length").over(inside), F.lit(0)))
        .join(groups, "group")
        .select("part", (F.col("files_before") + F.col("groups_before")).alias("before"))
    )
    parts = staged(parts, "parts")  # its size is known then, and ids aren't shuffled to meet it while it is small
    return rows.join(parts, "part").select(
        "doc_id",
        (F.col("before") + F.col("first")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids",
    )


def ids_crc32(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, and the checksum of the ids as little-endian 32-bit integers."""
    import zlib

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            values = ids.values.to_numpy().astype("<i4", copy=False)
            offsets = ids.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return read.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
