"""Exact top-k search by integer inner product with MaxScore.

A vector is a document, and its terms are (component, sign): a query component meets the postings of
its own sign with a gain and those of the other sign with a loss. A term's bound is its weight times
its largest entry in the shard. With the k-th best score known so far, the smallest bounds that
together stay below it are non-essential: a document that only occurs there cannot get in. The
essential postings are traversed; their documents are probed in the other terms, largest first, while
what they have and what is left to gain reaches the k-th best score. Shards' results are merged.

Components are floor(256 * x) in double precision. Scores are exact: where 64 bits might not hold a
sum, whole numbers of any size are used, and only a score beyond 64 bits is given as the nearest that
fits. Equal scores go by the least id. Vectors that are null, empty or hold null or non-finite
components, and rows without an id, take no part; zero vectors do; vectors only meet those of their
own length. Repeated rows count once. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietwire.llm import vectors
from quietwire.session import stage

SCALE = 256
# Documents scored outright to get a first k-th best score.
SEEDS = 64


def whole(rows: DataFrame) -> DataFrame:
    """(vec_id, v) with v as whole numbers, still held as doubles (floors of doubles are exact in them)."""
    return vectors.usable(rows, zero=True).select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))


def build(points: np.ndarray) -> dict:
    return {"points": points}


def _index(points: np.ndarray, most: float) -> dict:
    """Postings of every (component, sign): a mask of their documents, the largest entry, and the SEEDS largest ones."""
    exact = _fits(points, most)
    columns = np.ascontiguousarray(points.T.astype(np.int64)) if exact else np.vectorize(int, otypes=[object])(points.T)
    zero = columns[:, :1] * 0
    order = np.argsort(points.T, axis=1, kind="stable")
    return {
        "columns": columns,
        "exact": exact,
        "gain": {1: (columns > 0).astype(bool), -1: (columns < 0).astype(bool)},
        "largest": {1: np.maximum(columns.max(axis=1), zero[:, 0]), -1: np.minimum(columns.min(axis=1), zero[:, 0])},
        "head": {1: order[:, ::-1][:, :SEEDS], -1: order[:, :SEEDS]},
    }


def _fits(points: np.ndarray, most: float) -> bool:
    """Whether no sum of products can leave 64 bits."""
    return points.shape[1] * np.abs(points).max(initial=0) * most < 2**62


def _kth(scores: np.ndarray, k: int):
    """The k-th best score, or None while there are fewer."""
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None


def one(shard: dict, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of those that are or tie with the k best, of many ties the least ids."""
    columns, largest = shard["columns"], shard["largest"]
    n = columns.shape[1]
    w = query.astype(np.int64) if shard["exact"] else np.array([int(x) for x in query], object)
    up = (w > 0).astype(bool)
    gains = np.where(up, w * largest[1], w * largest[-1])
    terms = np.argsort(-gains, kind="stable")
    terms = terms[gains[terms] > 0]
    left = np.append(np.cumsum(gains[terms][::-1])[::-1], gains[:1] * 0)  # what the terms from i on can add
    # A first bar: the full scores of the documents at the head of the largest terms.
    heads = [shard["head"][1 if up[j] else -1][j] for j in terms[:4]]
    seeds = np.unique(np.concatenate(heads)) if heads else np.arange(min(n, SEEDS))
    bar = _kth(w @ columns[:, seeds], k)
    essential = len(terms) if bar is None else int((left[:-1] >= bar).sum())
    # A document outside the essential postings stays below the bar, unless the bar asks for no gain at all.
    met = np.full(n, bar is None or bar <= 0)
    have = np.zeros(n, columns.dtype)
    for j in terms[:essential]:
        have += w[j] * columns[j]
        met |= shard["gain"][1 if up[j] else -1][j]
    if bar is not None:
        met &= (have + left[essential] >= bar).astype(bool)
    alive = np.flatnonzero(met)
    have = have[alive]
    # The other terms, largest first, while a document can still reach the bar; then components that only lose.
    silent = np.flatnonzero((w != 0) & (gains == 0))
    for step, j in enumerate([*terms[essential:], *silent]):
        have = have + w[j] * columns[j, alive]
        if bar is not None and step % 4 == 3:
            stay = (have + left[min(essential + step + 1, len(terms))] >= bar).astype(bool)
            alive, have = alive[stay], have[stay]
    bar = _kth(have, k)
    if bar is not None:
        stay = (have >= bar).astype(bool)
        # Documents are in the order of their least ids: of those at the bar, the first k are enough.
        stay[np.flatnonzero(have == bar)[k:]] = False
        alive, have = alive[stay], have[stay]
    return alive, have


def _searcher(k: int):
    def search(shard: dict, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        most = float(np.abs(at).max(initial=0))
        if "columns" not in shard or (shard["exact"] and not _fits(shard["points"], most)):
            shard |= _index(shard["points"], most)
        out = []
        for place, query in enumerate(at):
            # The query's own row may be among the best, so one more than k.
            docs, scores = one(shard, query, k + 1)
            scores = np.clip(scores, -(2**63), 2**63 - 1).astype(np.int64)
            out.append(vectors.expand(np.full(len(docs), place), shard, docs, scores))
        return tuple(np.concatenate(c) for c in zip(*out))

    return search


def search(rows: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = vectors.SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query row among all rows but its own.

    ``rows`` and ``queries`` hold vec_id and embedding.
    """
    classes, shards = vectors.dealt(stage(vectors.folded(whole(rows), k), "different-vectors"), shard_rows)
    wanted = whole(queries).distinct().withColumnRenamed("vec_id", "query_id")
    found = vectors.met(vectors.pack_shards(classes, build), wanted, shards, _searcher(k), vectors.load, "bigint")
    return vectors.best(found, F.col("score").desc(), k)
