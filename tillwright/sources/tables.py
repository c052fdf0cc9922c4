"""Parquet tables of the warehouse: replace, append, and merge by partition.

A table folder holds ``data``, where every write has a folder of its own, and versions,
``v00000001`` and on. A version is a small file, the manifest, that names the folders of
every partition with their rows. It gets its name, by a rename, when it is complete, and the
highest is the current one, so a write of any number of partitions takes effect in
that one step: cut short before, it leaves the table as it was. Files that the last
``KEPT`` versions name stay, so that readers of the version before a write can
finish. A table has one writer at a time.
"""

import json
import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.operators.merge import upsert
from tillwright.sources.shared import shared_folder


KEPT = 2
#: Writes of an unpartitioned table beyond which an append rewrites it as one.
MOST_APPENDS = 32
_WRITE = "table_write"
#: Of the warehouse's files: half of snappy's size where text is random, such as hashes.
COMPRESSION = "zstd"


class _Staged(threading.local):
    """Folders staged by one thread: others may still be reading theirs."""

    def __init__(self):
        self.paths = []


_STAGED = _Staged()


def table_path(root: str, name: str) -> str:
    """``layer.table`` to ``root/layer/table``."""
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def _files(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path, file_system = _files(spark, path)
    file_system.delete(jvm_path, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    jvm_path, file_system = _files(spark, path)
    if not file_system.exists(jvm_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(jvm_path)]


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Version numbers, ascending.

    A folder with anything else in it isn't a table written here: rather than
    take it for an absent one and replace it, fail.
    """
    names = [n for n in _names(spark, path) if n != "data" and not n.startswith(".")]
    other = [n for n in names if not (n[:1] == "v" and n[1:].isdigit())]
    if other:
        raise ValueError(f"{path} holds {sorted(other)[:5]}, which no table write left there")
    return sorted(int(n[1:]) for n in names)


def _version_path(path: str, version: int) -> str:
    return f"{path}/v{version:08d}"


def _committed(spark: SparkSession, path: str) -> bool:
    jvm_path, file_system = _files(spark, f"{path}/_SUCCESS")
    return file_system.exists(jvm_path)


@dataclass
class Snapshot:
    """A version: its number, and the rows by (partition folder, number of the write)."""

    version: int
    rows: dict[tuple[str, int], int]
    schema: StructType

    @property
    def parts(self) -> list[tuple[str, int]]:
        return sorted(self.rows)


def _snapshot(spark: SparkSession, path: str, version: int) -> Snapshot:
    jvm_path, file_system = _files(spark, _version_path(path, version))
    stream = file_system.open(jvm_path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    rows = {(part, write): n for part, write, n in found["parts"]}
    return Snapshot(version, rows, StructType.fromJson(found["schema"]))


def current(spark: SparkSession, path: str) -> Snapshot | None:
    """The table's current version, None if there is no table."""
    versions = _versions(spark, path)
    return _snapshot(spark, path, versions[-1]) if versions else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a completely written table."""
    return bool(_versions(spark, path))


def _folder(path: str, part: str, write: int) -> str:
    return f"{path}/data/{_WRITE}={write}" + (f"/{part}" if part else "")


def _frame(spark: SparkSession, path: str, snapshot: Snapshot) -> DataFrame:
    if not snapshot.parts:
        return spark.createDataFrame([], snapshot.schema)
    folders = [_folder(path, part, write) for part, write in snapshot.parts]
    rows = spark.read.option("basePath", f"{path}/data").schema(snapshot.schema).parquet(*folders)
    return rows.select(*snapshot.schema.names)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    snapshot = current(spark, path)
    if snapshot is None:
        raise ValueError(f"no table at {path}")
    return _frame(spark, path, snapshot)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Within, shuffle files go when the query that wrote them ends. Else they stay until the
    driver collects its garbage, which may be hours: those of a whole run lie side by side."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new folder of the shared directory and read it back.

    Cuts the lineage with a table that outlives any executor, and frees the
    files ``df`` reads so that they can be replaced.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{uuid.uuid4().hex}"
    _STAGED.paths.append(path)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables this thread staged, except the first ``keep``."""
    while len(_STAGED.paths) > keep:
        _delete(spark, _STAGED.paths.pop())


def discard(df: DataFrame) -> None:
    """Delete one table this thread staged, once nothing reads it any more."""
    for name in df.inputFiles()[:1]:
        for path in [p for p in _STAGED.paths if p.rsplit("/", 1)[-1] in name]:
            _STAGED.paths.remove(path)
            _delete(df.sparkSession, path)


def staged_count() -> int:
    return len(_STAGED.paths)


def table_rows(spark: SparkSession, path: str) -> int:
    """The number of rows of a table, from its manifest."""
    return sum(current(spark, path).rows.values())


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values, as text, by which a plain folder of files is partitioned first."""
    return sorted(n.split("=", 1)[1] for n in _names(spark, path) if n.startswith(f"{column}="))


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """The partition folders below ``folder``, as paths from there."""
    if depth == 0:
        return [""]
    found = []
    for name in _names(spark, folder):
        if "=" in name:
            found += [f"{name}/{rest}".rstrip("/") for rest in _partitions(spark, f"{folder}/{name}", depth - 1)]
    return found


def _columns(partition_by) -> list[str]:
    return [partition_by] if isinstance(partition_by, str) else list(partition_by or ())


def _write(df: DataFrame, path: str, partition_by) -> tuple[int, dict[tuple[str, int], int]]:
    """Write ``df`` beside the table's data; returns the write's number and its partitions
    with their rows."""
    spark, columns = df.sparkSession, _columns(partition_by)
    if _WRITE in df.columns:
        raise ValueError(f"a table can't have a column {_WRITE}")
    used = [int(n.split("=")[1]) for n in _names(spark, f"{path}/data") if n.startswith(f"{_WRITE}=")]
    number = max([0, *_versions(spark, path), *used]) + 1
    folder = _folder(path, "", number)
    if columns:
        # Rebalancing splits a large partition over several tasks and joins small ones.
        df.hint("rebalance", *map(F.col, columns)).write.mode("error").option("compression", COMPRESSION).partitionBy(*columns).parquet(folder)
    else:
        df.write.mode("error").option("compression", COMPRESSION).parquet(folder)
    if not _committed(spark, folder):
        raise ValueError("Spark left no _SUCCESS: marksuccessfuljobs must not be switched off")
    found = dict.fromkeys(_partitions(spark, folder, len(columns)), 0)
    # No column is read, and names are taken apart once a file; one row comes back for each partition.
    files = spark.read.schema(df.schema).parquet(folder).groupBy(F.input_file_name().alias("file")).count()
    file = F.split(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), f"/{_WRITE}={number}/").getItem(1)
    where = F.regexp_replace(file, r"/?[^/]*$", "")
    written = files.groupBy(where.alias("part")).agg(F.sum("count").alias("n")).collect()
    found.update({r["part"]: r["n"] for r in written})
    return number, {(part, number): n for part, n in found.items()}


def _commit(spark: SparkSession, path: str, number: int, parts: dict[tuple[str, int], int], schema: StructType) -> None:
    """Make ``parts`` the table's version ``number``, then delete what no kept version names."""
    manifest = {"parts": [[part, write, n] for (part, write), n in sorted(parts.items())], "schema": schema.jsonValue()}
    hidden, file_system = _files(spark, f"{path}/.{uuid.uuid4().hex}")
    stream = file_system.create(hidden, False)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    named, _ = _files(spark, _version_path(path, number))
    if file_system.exists(named) or not file_system.rename(hidden, named):
        raise ValueError(f"another write made version {number} of {path}")
    _clean(spark, path, number)


def _clean(spark: SparkSession, path: str, number: int) -> None:
    versions = [v for v in _versions(spark, path) if v <= number]
    old, kept = versions[:-KEPT], versions[-KEPT:]
    named = {p for v in kept for p in _snapshot(spark, path, v).rows}
    dropped = {p for v in old for p in _snapshot(spark, path, v).rows} - named
    for version in old:
        _delete(spark, _version_path(path, version))
    whole = {write for _, write in named}
    for name in _names(spark, f"{path}/data"):
        write = int(name.split("=")[1])
        if write <= number and write not in whole:  # replaced as a whole, or left by a write cut short
            _delete(spark, f"{path}/data/{name}")
    for part, write in dropped:
        if part and write in whole:
            _delete(spark, _folder(path, part, write))


def _plain(df: DataFrame) -> StructType:
    """The schema as it comes back from files: columns may hold nulls."""
    return StructType.fromJson(json.loads(df.schema.json().replace('"nullable":false', '"nullable":true')))


def replace_table(df: DataFrame, path: str, partition_by=None) -> None:
    """Recompute-and-replace sink. ``df`` may read the table itself."""
    number, parts = _write(df, path, partition_by)
    _commit(df.sparkSession, path, number, parts, _plain(df))


def append_rows(df: DataFrame, path: str) -> None:
    """Append to an existing unpartitioned table."""
    spark, before = df.sparkSession, current(df.sparkSession, path)
    df = df.select(*before.schema.names)
    if len(before.parts) >= MOST_APPENDS:
        replace_table(_frame(spark, path, before).unionByName(df), path)
        return
    number, parts = _write(df, path, None)
    _commit(spark, path, number, before.rows | parts, before.schema)


def replace_partitions(df: DataFrame, path: str, partition_by) -> None:
    """Replace only the partitions present in ``df``, all in one step. ``df`` may read
    the table itself."""
    spark, before = df.sparkSession, current(df.sparkSession, path)
    if before is None:
        replace_table(df, path, partition_by)
        return
    number, parts = _write(df, path, partition_by)
    new = {part for part, _ in parts}
    kept = {p: n for p, n in before.rows.items() if p[0] not in new}
    _commit(spark, path, number, kept | parts, before.schema)


def merge_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys,
    update_cols,
    touch_cols=(),
    partition_by=None,
    newer_by=(),
) -> None:
    """Upsert ``batch`` into the table at ``path``, creating it if missing.

    With ``partition_by``, a column computed from the key, only the partitions
    that the batch touches are read and rewritten. A run cut short can simply be
    repeated, since applying a batch twice equals applying it once. ``newer_by``:
    see upsert.
    """
    before = current(spark, path)
    if before is None:
        replace_table(batch, path, partition_by)
        return
    target = _frame(spark, path, before).select(*batch.columns)
    if partition_by is None:
        replace_table(upsert(target, batch, keys, update_cols, touch_cols, newer_by), path)
        return
    batch = staged(batch)
    # One value per calendar month of the batch, used as a partition filter.
    touched = [row[0] for row in batch.select(partition_by).distinct().collect()]
    if not touched:
        discard(batch)
        return
    affected = target.filter(F.col(partition_by).isin(touched))
    merged = upsert(affected, batch, keys, update_cols, touch_cols, newer_by)
    replace_partitions(merged, path, partition_by)
    discard(batch)
