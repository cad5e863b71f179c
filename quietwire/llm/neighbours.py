"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Each shard's graph starts from random edges. Every vector is searched for in it, batch by batch, and
the nodes met on the way are pruned to its new out-edges: the nearest stays, and whatever is much
nearer to it than to the vector goes, and so on, so edges point in different directions. Back-edges
are added and pruned alike. A second pass relaxes the pruning by ALPHA, which keeps longer edges. A
query walks every shard's graph with a beam of BEAM nodes; the shards' results are merged. Where a
walk meets fewer nodes than are asked for, since its part of the graph leads nowhere else, that query
looks at every vector of the shard.

All rows are indexed: equal vectors are one node with their least ids, and shards are dealt by hash.
Nearness is the Euclidean distance in double precision, equal ones by the least id; walks use doubles
too, so neither a large offset nor a large or small scale loses neighbours. Vectors that
are null, empty, zero or hold null or non-finite components, and rows without an id, take no part;
vectors only meet those of their own length. Repeated rows count once. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietwire.llm import vectors
from quietwire.session import stage

DEGREE = 24
BEAM = 64
ALPHA = 1.2
BATCH = 256
# Beam nodes whose edges are followed at a time.
WIDTH = 4


def _squared(gap: np.ndarray) -> np.ndarray:
    """Squared lengths; what is beyond doubles is as far as they reach, so still a node to go on from."""
    with np.errstate(over="ignore"):
        return np.minimum(np.einsum("...j,...j->...", gap, gap), np.finfo(float).max)


def walk(x: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, squared distance) of the ``beam`` nearest met by each query, nearest first; node -1 where fewer."""
    n, m = len(queries), len(x)
    node = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf)
    done = np.zeros((n, beam), bool)
    node[:, 0] = entry
    far[:, 0] = _squared(queries - x[entry])
    seen = np.zeros(n * m, bool)
    seen[np.arange(n) * m + entry] = True
    row = np.arange(n)[:, None]
    while True:
        open_far = np.where(done | (node < 0), np.inf, far)
        pick = np.argpartition(open_far, WIDTH - 1, axis=1)[:, :WIDTH] if beam > WIDTH else np.tile(np.arange(beam), (n, 1))
        real = np.isfinite(np.take_along_axis(open_far, pick, 1))
        if not real.any():
            return node, far
        done[np.broadcast_to(row, pick.shape)[real], pick[real]] = True
        at = np.where(real, np.take_along_axis(node, pick, 1), -1)
        new = np.where(at[:, :, None] >= 0, edges[at], -1).reshape(n, -1)
        keys = (row * m + new)[new >= 0]
        keys = np.unique(keys[~seen[keys]])
        if not len(keys):
            continue
        seen[keys] = True
        owner, found = keys // m, keys % m
        gap = x[found] - queries[owner]
        distance = _squared(gap)
        count = np.bincount(owner, minlength=n)
        place = np.arange(len(keys)) - np.repeat(np.cumsum(count) - count, count)
        wide = int(count.max())
        more_node = np.full((n, wide), -1, np.int64)
        more_far = np.full((n, wide), np.inf)
        more_node[owner, place], more_far[owner, place] = found, distance
        node = np.concatenate([node, more_node], axis=1)
        far = np.concatenate([far, more_far], axis=1)
        done = np.concatenate([done, np.zeros((n, wide), bool)], axis=1)
        by = np.argsort(far, axis=1, kind="stable")[:, :beam]
        node, far, done = (np.take_along_axis(c, by, 1) for c in (node, far, done))


def prune(x: np.ndarray, own: np.ndarray, near: np.ndarray, alpha: float) -> np.ndarray:
    """Out-edges of nodes ``own`` from their candidates ``near`` (-1: none): the nearest, less what it makes needless."""
    n, c = near.shape
    near = np.where(near == own[:, None], -1, near)
    by = np.argsort(near, axis=1)
    near = np.take_along_axis(near, by, 1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    # Seen from the own node and in its scale, single precision tells what is needless whatever the offset.
    gap = x[near] - x[own][:, None, :]
    scale = np.abs(np.where(near[:, :, None] >= 0, gap, 0)).max(axis=(1, 2), initial=0)
    gap = np.clip(gap / np.where(scale > 0, scale, 1)[:, None, None], -1, 1).astype(np.float32)
    norm = np.einsum("ijk,ijk->ij", gap, gap)
    far = np.where(near >= 0, norm, np.inf)
    between = norm[:, :, None] + norm[:, None, :] - 2 * gap @ gap.transpose(0, 2, 1)
    edges = np.full((n, DEGREE), -1, np.int64)
    row = np.arange(n)
    for slot in range(DEGREE):
        best = np.argmin(far, axis=1)
        real = np.isfinite(far[row, best])
        if not real.any():
            break
        edges[real, slot] = near[row, best][real]
        needless = alpha * alpha * between[row, best] <= far
        far = np.where(needless & real[:, None], np.inf, far)
        far[row, best] = np.inf
    return edges


def _back(x: np.ndarray, edges: np.ndarray, own: np.ndarray, alpha: float) -> None:
    """Adds the reverse of the new edges of ``own``; nodes with too many are pruned."""
    target = edges[own].ravel()
    source = np.repeat(own, DEGREE)[target >= 0]
    target = target[target >= 0]
    by = np.lexsort((_squared(x[target] - x[source]), target))
    target, source = target[by], source[by]
    nodes, start, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(start, count)
    near = place < DEGREE  # the nearest of a node's new back-edges
    added = np.full((len(nodes), DEGREE), -1, np.int64)
    added[np.repeat(np.arange(len(nodes)), count)[near], place[near]] = source[near]
    for a in range(0, len(nodes), BATCH):
        part = nodes[a : a + BATCH]
        edges[part] = prune(x, part, np.concatenate([edges[part], added[a : a + BATCH]], axis=1), alpha)


def build(points: np.ndarray) -> dict:
    """Edges of a shard's graph, and where walks begin: the node nearest to the median, which outliers do not move."""
    x, m = points, len(points)
    random = np.random.default_rng(m)
    edges = random.integers(0, m, (m, DEGREE)) if m > 1 else np.full((1, DEGREE), -1)
    edges = np.where(edges == np.arange(m)[:, None], -1, edges).astype(np.int64)
    entry = int(np.argmin(_squared(x - np.median(x, axis=0))))
    for alpha in (1.0, ALPHA):
        order = random.permutation(m)
        for a in range(0, m, BATCH):
            own = order[a : a + BATCH]
            met, _ = walk(x, edges, entry, x[own], BEAM)
            edges[own] = prune(x, own, np.concatenate([met, edges[own]], axis=1), alpha)
            _back(x, edges, own, alpha)
    return {"points": points, "edges": edges.astype(np.int32), "entry": np.array(entry)}


def _searcher(k: int, beam: int):
    def search(shard: dict, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points = shard["points"]
        out = []
        for a in range(0, len(at), BATCH):
            node, _ = walk(points, shard["edges"], int(shard["entry"]), at[a : a + BATCH], max(beam, k + 1))
            lost = (node >= 0).sum(axis=1) < min(k + 1, len(points))
            place, slot = np.nonzero((node >= 0) & ~lost[:, None])
            found = node[place, slot]
            for q in np.flatnonzero(lost):
                place, found = np.append(place, np.full(len(points), q)), np.append(found, np.arange(len(points)))
            score = np.sqrt(((points[found] - at[a : a + BATCH][place]) ** 2).sum(axis=1))
            # One node may be the query itself, so k + 1 of them give k others; equal distances all stay.
            order = np.lexsort((score, place))
            place, found, score = place[order], found[order], score[order]
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            last = np.minimum(starts + k, np.concatenate([starts[1:], [len(place)]]) - 1)
            stay = score <= np.repeat(score[last], np.diff(np.concatenate([starts, [len(place)]])))
            out.append(vectors.expand(place[stay] + a, shard, found[stay], score[stay]))
        return tuple(np.concatenate(c) for c in zip(*out))

    return search


def search(rows: DataFrame, queries: DataFrame, k: int = 10, beam: int = BEAM, shard_rows: int = vectors.SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row among all rows but its own.

    ``rows`` and ``queries`` hold vec_id and embedding.
    """
    classes, shards = vectors.dealt(stage(vectors.folded(vectors.usable(rows, zero=False), k), "different-vectors"), shard_rows)
    wanted = vectors.usable(queries, zero=False).distinct().withColumnRenamed("vec_id", "query_id")
    found = vectors.met(vectors.pack_shards(classes, build), wanted, shards, _searcher(k, beam), vectors.load, "double")
    return vectors.best(found, F.col("score").asc(), k)
