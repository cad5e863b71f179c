"""What several operators share: whole-text words, bounded batches, numbering, staged tables."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quietwire.session import stage

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of an Arrow batch: texts of a few kB make some MB, so a Python worker stays small.
BATCH_ROWS = 1000

_UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the Python stages rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    with contextlib.suppress(Exception):  # not every version knows it
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{table}.parquet")


def give_back() -> None:
    """Hands freed memory back to the system: workers are reused, and an idle one would keep the peak of its last task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library may know no trimming
        ctypes.CDLL(None).malloc_trim(0)


def in_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    prepare(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return df.mapInArrow(task, schema)


def free(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column has it (names are told apart without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 of every text of a batch; a null text is empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection on 64-bit values that leaves no pattern (multiply, fold, twice)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
        return x ^ (x >> np.uint64(32))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_powers = np.ones(1, np.uint64)


def _powers_to(length: int) -> np.ndarray:
    global _powers
    if length > len(_powers):
        steps = np.full(max(length, 256), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def hash_words(text: bytes, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, first byte) of every word, all words at once; a block of bytes at a time for long texts."""
    raw = np.frombuffer(text, np.uint8)
    solid = ~_SPACE[raw]
    edge = np.diff(solid, prepend=False, append=False)
    bounds = np.flatnonzero(edge)
    starts, lengths = bounds[::2], bounds[1::2] - bounds[::2]
    out = np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + block)))
        size = lengths[a:b]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        signs = raw[starts[a] : starts[b - 1] + size[-1]][solid[starts[a] : starts[b - 1] + size[-1]]]
        with np.errstate(over="ignore"):
            values = _powers_to(int(size.max()))[place] * (signs.astype(np.uint64) + np.uint64(1))
            out[a:b] = np.add.reduceat(values, first) + size.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
        a = b
    return mix(out), starts


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def numbered(df: DataFrame, order: list[Column], groups: list[str], position: str, label: str, few: bool = False) -> DataFrame:
    """Adds ``position``, from 0 within each group, without bringing a group into one task.

    Rows are range partitioned by (group, order) and written once, so their places are fixed. The
    pieces of a group in the partitions before, counted per partition, give each piece its start.
    Groups must not hold nulls. The joined table has a row per piece: partitions plus groups; it is
    broadcast only where the caller knows that there are ``few`` groups.
    """
    keys = [F.col(g) for g in groups] + order
    placed = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_piece", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    )
    by = [*groups, "_piece"]
    pieces = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = earlier.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(*by, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(starts) if few else starts, by).withColumn(position, F.col("_at") + F.col("_shift")).drop("_piece", "_at", "_shift")


def salt(text: Column) -> Column:
    """Tells rows with one id apart by their text, in 31 bits."""
    return F.hash(text).bitwiseAND(0x7FFFFFFF)


def rejoin(docs: DataFrame, decided: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` where ``decided`` has a row for (doc_id, _salt), and that row as a struct of its own free name.

    The side without texts is hashed, so texts are moved once and never sorted.
    """
    name = free("_decided", docs.columns)
    row = F.col(name)
    right = decided.select(F.struct(*decided.columns).alias(name))
    same = F.col("doc_id").eqNullSafe(row["doc_id"]) & (salt(F.col("text")) == row["_salt"])
    return docs.join(right.hint("shuffle_hash"), same), row
