"""Vectors as a search needs them: the usable ones, equal ones folded, dealt into shards, met by blocks of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietwire.llm.common import in_batches
from quietwire.session import stage

# Different vectors of a shard, and queries that meet a copy of it together.
SHARD_ROWS = 4096
QUERY_BLOCK = 4096

_FOUND = "query_id bigint, vec_id bigint, score {}"


def usable(rows: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, v) of vectors with finite components only; zero vectors only where asked for."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    stay = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite
    if not zero:
        stay = stay & F.exists(v, lambda x: x != 0)
    return rows.where(stay).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))


def folded(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each different vector once, with its k + 1 least ids. A result never needs more of them.

    The least ids are picked per task first, so a vector that many rows share sends a few of them.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    least = rows.distinct().withColumn("_place", place).where(F.col("_place") <= k + 1)
    return least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def dealt(classes: DataFrame, shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """Adds dim and shard to the classes; and (dim, shards), the number of shards per dimension."""
    classes = classes.withColumn("dim", F.size("v"))
    shards = stage(classes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards")), "shards")
    return classes.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards"))).drop("shards"), shards


def met(
    packed: DataFrame,
    queries: DataFrame,
    shards: DataFrame,
    search: Callable[[dict, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    load: Callable[[bytes], dict],
    kind: str,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of every query over all shards.

    ``packed`` holds a shard per row (dim, shard, payload). Each block of queries gets every shard
    once: shards and queries are shuffled to (dim, shard, block), and a task reads the shard, then
    streams its queries. ``search`` returns (position of the query, vec_id, score) of candidates.
    """
    queries = stage(queries.withColumn("dim", F.size("v")), "queries")
    blocks = max(1, -(-queries.count() // query_block))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    left = packed.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind"), "payload")
    left = left.withColumns({"query_id": F.lit(None).cast("bigint"), "v": F.lit(None).cast("array<double>")})
    right = queries.join(shards, "dim").select(
        "dim",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"),
        block.alias("block"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("binary").alias("payload"),
        "query_id",
        "v",
    )
    keys = ["dim", "shard", "block"]
    rows = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys, "kind", "query_id")
    rows = rows.select("kind", "payload", "query_id", "v")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: dict = {}
        for batch in batches:
            kinds = batch.column(0).to_numpy()
            # A shard and the queries after it, up to the next shard.
            starts = np.unique(np.concatenate([[0], np.flatnonzero(kinds == 0)]))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(kinds)]):
                if kinds[a] == 0:
                    shard = load(batch.column(1)[a].as_py())
                    a += 1
                if a < b:
                    part = batch.slice(a, b - a)
                    ids = part.column(2).to_numpy()
                    at = np.array([x.as_py() for x in part.column(3)], float)
                    place, vec, score = search(shard, ids, at)
                    own = vec != ids[place]
                    arrays = [pa.array(ids[place][own]), pa.array(vec[own]), pa.array(score[own])]
                    yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    found = in_batches(rows, work, _FOUND.format(kind))
    return found


def best(found: DataFrame, order: Column, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def expand(place: np.ndarray, shard: dict, classes: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Found classes as rows of their ids."""
    starts, ids = shard["starts"], shard["ids"]
    count = starts[classes + 1] - starts[classes]
    first = np.repeat(starts[classes] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return np.repeat(place, count), ids[first + np.arange(int(count.sum()))], np.repeat(score, count)


def packed_ids(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    return starts, np.array([x for one in ids for x in one], np.int64)


def pack_shards(classes: DataFrame, build: Callable[[np.ndarray], dict]) -> DataFrame:
    """(dim, shard, payload) written once: what ``build`` makes of a shard's vectors, and the ids of each."""

    def work(table: pa.Table) -> pa.Table:
        from io import BytesIO

        order = np.argsort([x[0].as_py() for x in table.column("ids")], kind="stable")  # so that a rerun builds the same
        table = table.take(pa.array(order))
        starts, ids = packed_ids(table.column("ids").to_pylist())
        out = BytesIO()
        vectors = np.array(table.column("v").to_pylist(), float)
        np.savez(out, starts=starts, ids=ids, **build(vectors))
        return pa.table({"dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "payload": pa.array([out.getvalue()], pa.binary())})

    packed = classes.select("dim", "shard", "v", "ids").groupBy("dim", "shard").applyInArrow(work, "dim int, shard bigint, payload binary")
    return stage(packed, "packed-shards")


def load(payload: bytes) -> dict:
    from io import BytesIO

    with np.load(BytesIO(payload)) as arrays:
        return {name: arrays[name] for name in arrays.files}
