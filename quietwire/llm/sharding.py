"""Shards along a Hilbert curve, in DataFrame operations only.

Source, size and document id are quantised to a grid: sources by their rank among the different ones,
ids by approximate quantiles, sizes by powers of two. Rows are sorted by the place of their cell on
a Hilbert curve through the grid, equal texts next to each other, and the order is cut into runs of
equal length. Neighbours on the curve are neighbours in every dimension, so each shard, written as a
file, spans a small range of each of them, and readers skip files by any of them.

The law is ``rows``: shards differ by at most one row. Row numbers come from range partitions and
their counts; no task sees more than its share, whatever a cell or a group of copies holds.

A null text has no bytes and the checksum of the empty text. Null sources and ids have a
cell of their dimension to themselves. Repeated rows are placed each by itself. An empty table gives no rows;
fewer rows than shards leave the last shards empty. Other columns are not looked at; where one is
called ``shard``, the folders of written shards are named ``shard_``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import free, numbered
from quietwire.session import stage

SHARDS = 40
DIMENSIONS, BITS = 3, 4
OVERHEAD = 16
CELLS = 1 << BITS


def _turn(point: list[int], bits: int) -> list[int]:
    """The Gray-coded digits of a point: each level undoes the mirroring and swapping of the levels above."""
    x = list(point)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i, value in enumerate(x):
            if value & level:
                x[0] ^= below
            else:
                swap = (x[0] ^ value) & below
                x[0] ^= swap
                x[i] ^= swap
        level >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    carry = 0
    for bit in range(bits - 1, 0, -1):
        if x[-1] >> bit & 1:
            carry ^= (1 << bit) - 1
    return [value ^ carry for value in x]


@lru_cache(maxsize=4)
def curve(dimensions: int = DIMENSIONS, bits: int = BITS) -> dict[tuple[int, ...], int]:
    """Every cell's place on the curve."""
    places = {}
    for point in product(range(1 << bits), repeat=dimensions):
        digits, place = _turn(list(point), bits), 0
        for bit in range(bits - 1, -1, -1):
            for value in digits:
                place = place << 1 | value >> bit & 1
        places[point] = place
    return places


@lru_cache(maxsize=1)
def table() -> str:
    """The places of all cells in cell order, as three hexadecimal digits each."""
    places = curve()
    return "".join(f"{places[p]:03x}" for p in product(range(CELLS), repeat=DIMENSIONS))


@dataclass(frozen=True)
class Grid:
    """The least value of every cell but the first, for sources and ids: at most CELLS - 2 of each."""

    sources: tuple[str, ...] = ()
    ids: tuple[int, ...] = ()


def grid(rows: DataFrame) -> Grid:
    """Cuts the different sources into equally many per cell, and the rows by id."""
    cells = CELLS - 1
    sources = stage(rows.where("_source is not null").select("_source").distinct(), "sources")
    total = sources.count()
    ranked = numbered(sources, [F.col("_source")], [], "_rank", "ranked-sources", few=True)
    wanted = {-(-total * i // cells) for i in range(1, cells)} - {0}
    cuts = ranked.where(F.col("_rank").isin(sorted(wanted))).select("_source").orderBy("_source").collect() if wanted else []
    shares = [i / cells for i in range(1, cells)]
    ids = rows.agg(F.percentile_approx("doc_id", shares, 10_000).alias("ids")).first()["ids"]
    return Grid(tuple(r["_source"] for r in cuts), tuple(sorted(set(ids or ()))))


def _cell(value: Column, cuts: tuple) -> Column:
    """0 for a null, then one cell more for every cut that is reached."""
    reached = [(value >= F.lit(cut)).cast("int") for cut in cuts]
    return F.when(value.isNull(), 0).otherwise(sum(reached, F.lit(1)))


def _octave(size: Column) -> Column:
    """Sizes by powers of two, from the least possible one on."""
    return F.least(F.length(F.bin(size)) - OVERHEAD.bit_length(), F.lit(CELLS - 1))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, checksum and the numbers to quantise; texts go no further."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(raw) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.col("source").alias("_source"),
    )


def placed(rows: DataFrame, cuts: Grid) -> DataFrame:
    """Adds ``place``, the cell's place on the curve."""
    source, number = _cell(F.col("_source"), cuts.sources), _cell(F.col("doc_id"), cuts.ids)
    cell = (source * CELLS + _octave(F.col("size"))) * CELLS + number
    return rows.withColumn("place", F.conv(F.substring(F.lit(table()), cell * 3 + 1, F.lit(3)), 16, 10).cast("int"))


ORDER = ("place", "text_crc32", "doc_id", "size")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, place, law, shard, slot, grown_shard of every row."""
    rows = stage(measured(docs), "sizes")
    return _cut(rows, grid(rows), shards)


def _cut(rows: DataFrame, cuts: Grid, shards: int) -> DataFrame:
    total = rows.count()
    ranked = numbered(placed(rows, cuts), [F.col(c) for c in ORDER], [], "_rank", "along-the-curve", few=True)
    number = F.expr(f"_rank * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", number.cast("int"))
        .withColumn("slot", F.col("_rank") - first)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
            "place",
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Writes all columns of ``docs`` as one sorted file per shard under ``path``/shard=N.

    Only the first key of every shard is gathered, so rows find their shard in the pass that moves
    them. Rows equal in place, checksum, id and size stay together, also at a cut.
    """
    sizes = stage(measured(docs), "sizes")
    cells = grid(sizes)
    firsts = _cut(sizes, cells, shards).where("slot = 0 and shard > 0").select("shard", F.struct(*ORDER).alias("key"))
    keys = [r["key"] for r in firsts.orderBy("shard").collect()]  # one per shard
    folder = free("shard", docs.columns)
    rows = placed(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(F.encode(F.coalesce("text", F.lit("")), "UTF-8")) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
            F.col("source").alias("_source"),
            F.struct(*docs.columns).alias("_row"),
        ),
        cells,
    )
    key = F.struct(*ORDER)
    kinds = [rows.schema[c].dataType for c in ORDER]
    passed = [(key >= F.struct(*(F.lit(k[c]).cast(t).alias(c) for c, t in zip(ORDER, kinds)))).cast("int") for k in keys]
    number = sum(passed, F.lit(0))
    (
        rows.select(number.alias("_shard"), *ORDER, "_row")
        .repartitionByRange(max(len(keys) + 1, 1), "_shard", *ORDER)
        .sortWithinPartitions("_shard", *ORDER)
        .select("_row.*", F.col("_shard").alias(folder))
        .write.partitionBy(folder)
        .parquet(path)
    )
