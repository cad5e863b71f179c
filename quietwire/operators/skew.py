"""Joins and numbering that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietwire.session import size_of, stage

# A key with more rows is split into parts of this many, whatever the size of the data.
HOT_ROWS = 200_000
# A list of hot keys up to this long is broadcast; a longer one is joined.
HOT_KEYS = 100_000
# A lookup side up to this many rows and bytes of files is broadcast; beyond it the join is shuffled.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def hot_keys(counts: DataFrame, keys: list[str], rows: str) -> DataFrame | None:
    """The keys with more than HOT_ROWS rows and ``_salts``, the parts each is split into.

    None when no key is that long, so that the join needs no salting at all.
    """
    hot = counts.where(F.col(rows) > HOT_ROWS).select(*keys, F.ceil(F.col(rows) / HOT_ROWS).cast("int").alias("_salts"))
    if hot.isEmpty():
        return None
    hot = stage(hot, "hot-keys")
    return F.broadcast(hot) if hot.count() <= HOT_KEYS else hot


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    hot: DataFrame | None,
    spread: Column,
    how: str = "inner",
    null_keys: bool = False,
) -> DataFrame:
    """Equi-join whose hot keys are spread over parts of at most about HOT_ROWS rows.

    ``hot`` lists values of ``keys`` or of some of them, with ``_salts``. ``spread`` is a column of
    ``big`` that varies within a key. Only rows of ``small`` under a hot key are repeated, once per
    salt, so each row of ``big`` still meets each match once. With ``null_keys`` the rows of ``big``
    that can meet nothing are spread as well.
    """
    left, right = big, small
    salts = F.lit(1)
    if hot is not None:
        by = [c for c in hot.columns if c != "_salts"]
        left, right = big.join(hot, by, "left"), small.join(hot, by, "left")
        salts = F.coalesce("_salts", F.lit(1))
    if null_keys:
        # They meet nothing, so any spread will do.
        salts = F.when(reduce(or_, (F.col(key).isNull() for key in keys)), F.lit(1 << 20)).otherwise(salts)
    elif hot is None:
        return big.join(small, keys, how)
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("_salts")
    if hot is None:
        right = right.withColumn("_salt", F.lit(0))
    else:
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, staged: DataFrame, keys: list[str], spread: Column, how: str = "inner") -> DataFrame:
    """Attach the single row that ``staged`` (a staged table, unique on ``keys``) holds per key.

    Its row count is read from the file footers, its bytes from the files. A small one is broadcast
    and ``big`` is not moved at all; a larger one is shuffled, with the hot keys of ``big`` salted.
    """
    if staged.count() <= BROADCAST_ROWS and size_of(staged) <= BROADCAST_BYTES:
        return big.join(F.broadcast(staged), keys, how)
    counts = stage(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    return salted_join(big, staged, keys, hot_keys(counts, keys, "_rows"), spread, how, null_keys=how == "left")


def number_rows(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``row_number()`` per group without bringing a group into one task.

    Rows are range partitioned by (group, order) and staged, so the positions are fixed. Each
    (group, partition) piece then starts after the pieces of its group before it.
    """
    keys = [*groups, *order]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_piece", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = stage(placed, "placed")
    pieces = placed.groupBy(*groups, "_piece").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return (
        placed.join(starts, [*groups, "_piece"])
        .withColumn(name, F.col("_before") + F.col("_at") - F.col("_first") + 1)
        .drop("_piece", "_at", "_before", "_first")
    )
