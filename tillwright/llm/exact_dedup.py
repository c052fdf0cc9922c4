"""Exact duplicates found by counting quotient filters.

A text's 64-bit fingerprint is split into a quotient (high bits) and a remainder
(low bits). A filter holds, for each quotient, a run of remainders in ascending
order, each with a counter. Every partition builds the filter of its own rows;
runs of the same quotient merge by merging their sorted remainders and adding
the counters, which loses nothing. A fingerprint whose merged counter is one
belongs to a text that occurs once. All others go to byte verification: their
rows are grouped by the normalised text itself, so that a collision of
fingerprints can't merge different texts.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.shared import id_and_text, staged

#: Deleted before texts are compared: the bytes of [\x20\x09-\x0D].
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: Fingerprints that the runs of one quotient hold on average after merging.
RUN_LENGTH = 1 << 14
#: Parts in which the rows of one fingerprint reach the verification.
SALTS = 16

_DIGEST = "doc_id long, row long, row2 long, n_points long, fingerprint long, text_sha256 string"
_RUN = "quotient long, remainders array<long>, counts array<long>"


def _normalised(batch: pa.RecordBatch):
    for text in batch.column("text").cast(pa.large_binary()).to_pylist():
        yield text.translate(None, WHITE_SPACE)


def _fingerprint(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _digests(batches):
    for batch in batches:
        prints, shas = [], []
        for text in _normalised(batch):
            prints.append(_fingerprint(text))
            shas.append(hashlib.sha256(text).hexdigest())
        lengths = pc.utf8_length(batch.column("text")).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(name) for name in ("doc_id", "row", "row2")),
                lengths,
                pa.array(prints, pa.int64()),
                pa.array(shas, pa.string()),
            ],
            names=["doc_id", "row", "row2", "n_points", "fingerprint", "text_sha256"],
        )


def _texts(batches):
    for batch in batches:
        texts = list(_normalised(batch))
        lengths = pc.utf8_length(batch.column("text")).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("row"),
                lengths,
                pa.array(map(_fingerprint, texts), pa.int64()),
                pa.array(texts, pa.binary()),
            ],
            names=["doc_id", "row", "n_points", "fingerprint", "normalised"],
        )


def _runs(prints: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted distinct fingerprints and their counters as the runs of a filter."""
    unsigned = (prints.astype(np.int64).view(np.uint64)) ^ np.uint64(1 << 63)
    quotients = (unsigned >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(prints), np.int64)
    starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]]) if len(prints) else np.zeros(0, np.int64)
    offsets = pa.array(np.r_[starts, len(prints)], pa.int32())
    rest = (unsigned & np.uint64((1 << (64 - bits)) - 1)).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(quotients[starts], pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(rest)),
            pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64))),
        ],
        names=["quotient", "remainders", "counts"],
    )


def _filters(bits: int):
    """The filter of each batch of a partition. Batches hold at most as many rows
    as Spark's Arrow setting says, so the memory doesn't grow with the partition."""

    def build(batches):
        for batch in batches:
            yield _runs(*np.unique(batch.column(0).to_numpy(), return_counts=True), bits)

    return build


def _merge(table: pa.Table) -> pa.Table:
    """One run from all runs of a quotient."""
    remainders = table.column("remainders").combine_chunks().flatten().to_numpy().view(np.uint64)
    counts = table.column("counts").combine_chunks().flatten().to_numpy()
    distinct, place = np.unique(remainders, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, counts)
    return pa.table(
        {
            "quotient": table.column("quotient").slice(0, 1),
            "remainders": pa.array([distinct.view(np.int64)], pa.list_(pa.int64())),
            "counts": pa.array([total], pa.list_(pa.int64())),
        }
    )


def quotient_filter(prints: DataFrame, n_rows: int, run_length: int = RUN_LENGTH) -> DataFrame:
    """The merged filter of a frame with one column ``fingerprint``.

    Quotients get as many bits as keep a merged run near ``run_length`` values.
    A frequent fingerprint is one counter in each batch's filter, so it can't
    make a run long.
    """
    bits = max(0, min(40, int(np.ceil(np.log2(max(1, n_rows / run_length))))))
    parts = prints.select("fingerprint").mapInArrow(_filters(bits), _RUN)
    merged = parts.groupBy("quotient").applyInArrow(_merge, _RUN)
    return merged.withColumn("bits", F.lit(bits))


def repeated(filters: DataFrame) -> DataFrame:
    """The fingerprints whose counter is above one."""
    each = filters.select("quotient", "bits", F.explode(F.arrays_zip("remainders", "counts")).alias("slot"))
    high = F.when(F.col("bits") > 0, F.expr("shiftleft(quotient, 64 - bits)")).otherwise(F.lit(0).cast("long"))
    value = high.bitwiseOR(F.col("slot.remainders")).bitwiseXOR(F.lit(-(1 << 63)))
    return each.filter("slot.counts > 1").select(value.alias("fingerprint"))


def exact_duplicates(docs: DataFrame, run_length: int = RUN_LENGTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size,
    kept, text_sha256.

    Texts are equal when their bytes are, after deleting ``WHITE_SPACE``. Of a
    group the row with the most code points stays, then the smallest doc_id,
    null ids last. A null text is an empty one; empty texts are equal to each
    other. Rows that repeat a doc_id and its text are members of the group like
    any others; if theirs is the row that stays, each of them is marked kept
    (``keep_one`` leaves a single one). An empty table gives no rows, and columns
    other than the two aren't read.
    """
    return _judged(docs, run_length).drop("stays", "row", "row2")


def _judged(docs: DataFrame, run_length: int = RUN_LENGTH) -> DataFrame:
    """``exact_duplicates`` with each row's key, and whether it is the one that stays:
    of rows alike in id and length, those of the smallest key do."""
    texts = id_and_text(docs)
    texts = texts.withColumns({"row": row_key(texts), "row2": row_key(texts, F.lit(1))})
    digests = staged(texts.mapInArrow(_digests, _DIGEST), "digests")
    filters = quotient_filter(digests, digests.count(), run_length)
    again = staged(repeated(filters), "repeated")

    # Rows of a hot fingerprint arrive in parts; equal texts collapse before the
    # second shuffle, and one row per distinct text is left.
    salted = again.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    routed = (
        texts.mapInArrow(_texts, "doc_id long, row long, n_points long, fingerprint long, normalised binary")
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        .join(salted, ["fingerprint", "salt"], "left_semi")
    )
    first = F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("first")
    groups = (
        routed.groupBy("fingerprint", "normalised")
        .agg(first, F.count(F.lit(1)).alias("size"))
        .select(
            F.sha2("normalised", 256).alias("text_sha256"),
            (-F.col("first.col1")).alias("keep_points"),
            F.col("first.doc_id").alias("keep_id"),
            F.col("first.row").alias("keep_row"),
            "size",
        )
    )
    grouped = F.col("size").isNotNull()
    return digests.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (~grouped | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")))).alias(
            "kept"
        ),
        "text_sha256",
        "row",
        "row2",
        (~grouped | (F.col("row") == F.col("keep_row"))).alias("stays"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, each once."""
    return keep_rows(docs, _judged(docs).select("row", "row2", "stays"))


def row_key(docs: DataFrame, *more):
    """A hash of a row's id and text, by which decisions about rows are carried back. Two of
    them, the second with a literal, tell apart rows that one might not."""
    return F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")), *more)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """``names``, made longer where ``docs`` has them already."""
    out = []
    for name in names:
        while name in docs.columns:
            name += "_"
        out.append(name)
    return out


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay by ``decided`` (row, row2: ``row_key``; stays), one for
    each id and text.

    The rows that go, and those repeated as they are, are met by their keys: these are
    joined without shuffling any text as long as their table is small.
    """
    decided = staged(decided, "decided")
    again = staged(
        decided.filter("stays").groupBy("row", "row2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "again"
    )
    key, key2 = unused(docs, "_row", "_row2")
    gone = decided.filter("NOT stays").select("row", "row2").distinct()
    keyed = docs.withColumns({key: row_key(docs), key2: row_key(docs, F.lit(1))})

    def of(keys: DataFrame):
        return keys.select(F.col("row").alias(key), F.col("row2").alias(key2))

    gone = staged(of(gone.unionByName(again)), "gone")
    once = keyed.join(gone, [key, key2], "left_anti")
    repeated = keyed.join(of(again), [key, key2], "left_semi").dropDuplicates([key, key2])
    return once.unionByName(repeated.select(*once.columns)).drop(key, key2).select(*docs.columns)
