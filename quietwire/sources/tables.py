"""Keyed tables in Parquet, written in versions: scans and upserts.

Files are only ever added, under a folder of their own for each write. A manifest names the folders that make up the
table; a write ends with renaming the next manifest into place. Until then readers see the table as it was, so a
crash at any point leaves it whole, and files that no manifest names are never read. Of two writers
that start from one version the later one fails. ``vacuum`` removes what older versions alone named.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietwire.operators.skew import BROADCAST_ROWS
from quietwire.session import stage


_VERSION = "_v"


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> list[int]:
    system, place = _file_system(spark, f"{path}/_manifest")
    names = [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []
    return sorted(int(name[:12]) for name in names if re.fullmatch(r"\d{12}\.json", name))


def _folders(spark: SparkSession, path: str, version: int) -> dict[str, str]:
    """Of each partition, the folder that holds its rows in this version, both relative to the table."""
    system, place = _file_system(spark, f"{path}/_manifest/{version:012d}.json")
    stream = system.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]] | None:
    """(version, folders) as of now; None where there is no such table yet."""
    versions = _versions(spark, path)
    return (versions[-1], _folders(spark, path, versions[-1])) if versions else None


def _commit(spark: SparkSession, path: str, version: int, folders: dict[str, str]) -> None:
    """Makes ``folders`` the table by one rename."""
    system, draft = _file_system(spark, f"{path}/_manifest/.{uuid.uuid4().hex}")
    out = system.create(draft)
    try:
        out.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
    finally:
        out.close()
    _, place = _file_system(spark, f"{path}/_manifest/{version:012d}.json")
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise RuntimeError(f"another writer has changed {path} meanwhile")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of now. A folder without a manifest is read as plain Parquet."""
    path, known = path.rstrip("/"), manifest(spark, path.rstrip("/"))
    if known is None:
        return spark.read.schema(schema).parquet(path)
    folders = [f"{path}/{folder}" for folder in known[1].values()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def create_table(spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None) -> None:
    """An empty table, unless there is one."""
    if manifest(spark, path) is None:
        _commit(spark, path.rstrip("/"), 0, {})


def _added(spark: SparkSession, path: str, rows: DataFrame, partition: str | None) -> dict[str, str]:
    """Writes rows to new folders of the table; nothing names them yet."""
    label = f"x{uuid.uuid4().hex}"
    by = [partition, _VERSION] if partition else [_VERSION]
    rows.withColumn(_VERSION, F.lit(label)).write.mode("append").partitionBy(*by).parquet(path)
    system, pattern = _file_system(spark, f"{path}/{partition}=*/{_VERSION}={label}" if partition else f"{path}/{_VERSION}={label}")
    found = [status.getPath() for status in system.globStatus(pattern)]
    if not partition:
        return {"": f.getName() for f in found}
    return {f.getParent().getName(): f"{f.getParent().getName()}/{f.getName()}" for f in found}


def replace_table(spark: SparkSession, path: str, rows: DataFrame, partition: str | None = None) -> None:
    """Makes ``rows`` the whole table."""
    path = path.rstrip("/")
    known = manifest(spark, path)
    _commit(spark, path, known[0] + 1 if known else 0, _added(spark, path, rows, partition))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes the manifests before the last ``keep`` and the folders that only they name. For when no run
    reads or writes the table. Returns the number of folders."""
    path, versions = path.rstrip("/"), _versions(spark, path.rstrip("/"))
    stay = {folder for v in versions[-keep:] for folder in _folders(spark, path, v).values()}
    gone = {folder for v in versions[:-keep] for folder in _folders(spark, path, v).values()} - stay
    names = [f"{path}/{folder}" for folder in gone] + [f"{path}/_manifest/{v:012d}.json" for v in versions[:-keep]]
    for name in names:
        system, place = _file_system(spark, name)
        system.delete(place, True)
    return len(gone)


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    update: list[str] | None = None,
    insert_only: bool = False,
) -> DataFrame:
    """The table after the write. Both sides must be unique on ``keys`` (see ``last_per_key``).

    Without ``insert_only``, matched rows take the ``update`` columns (default: every non-key
    column of ``incoming``) and keep the others. An empty ``update`` counts as not given.
    """
    values = [c for c in incoming.columns if c not in keys]
    if insert_only or not values:
        fresh = incoming.join(target.select(*keys), keys, "left_anti")
        return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)
    changed = set(update or values)
    old = target.withColumn("_old", F.lit(True))
    new = incoming.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in values)).withColumn("_new", F.lit(True))

    def merged(column: str):
        if column in keys or column not in values:
            return F.col(column)
        takes = F.col("_new") if column in changed else F.col("_new") & F.col("_old").isNull()
        return F.when(takes, F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)

    return old.join(new, keys, "full_outer").select(*(merged(c) for c in target.columns))


def in_partitions(table: DataFrame, partition: str, values: list) -> DataFrame:
    """The rows of these partitions. The values are literals, so no other folder is opened."""
    column, known = F.col(partition), [v for v in values if v is not None]
    wanted = column.isin(known) if known else F.lit(False)
    return table.where(wanted | column.isNull()) if len(known) < len(values) else table.where(wanted)


def _touched(target: DataFrame, incoming: DataFrame, rows: int, keys: list[str], partition: str, follows: bool) -> list:
    """The partitions that an upsert changes: one value each."""
    parts = incoming.select(partition)
    if not follows:
        # Stored rows may lie elsewhere. Only their keys are looked through; a short list of new ones goes to them.
        new = incoming.select(*keys)
        stored = target.select(*dict.fromkeys([*keys, partition]))
        parts = parts.union(stored.join(F.broadcast(new) if rows <= BROADCAST_ROWS else new, keys, "left_semi").select(partition))
    return [r[0] for r in parts.distinct().collect()]


def upsert_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    incoming: DataFrame,
    keys: list[str],
    partition: str,
    insert_only: bool = False,
    keep: tuple[str, ...] = ("fetched_at",),
    follows: bool = False,
) -> int:
    """Upsert into a partitioned table, reading and writing anew only the partitions that hold touched rows.

    ``partition`` is a column of the table that is set on insert and never changes, so no row
    moves; nor do the ``keep`` columns. Where it ``follows`` from the keys (the year of a date),
    the incoming rows name all partitions; else the stored keys are looked through first. A plain
    folder is taken over whole by its first upsert. Returns the number of incoming rows.
    """
    path = path.rstrip("/")
    incoming = stage(incoming, "incoming")
    rows = incoming.count()
    if rows == 0:
        return 0
    known = manifest(spark, path)
    target = read_table(spark, path, schema)
    touched = None if known is None else _touched(target, incoming, rows, keys, partition, follows)
    current = target if touched is None else in_partitions(target, partition, touched)
    stays = [c for c in incoming.columns if c not in (*keys, partition, *keep)]
    after = stage(upsert(current, incoming, keys, update=stays, insert_only=insert_only), "upserted")
    version, folders = known or (-1, {})
    _commit(spark, path, version + 1, folders | _added(spark, path, after, partition))
    return rows
