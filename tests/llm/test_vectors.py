import math
import random

import numpy as np
import pytest

from quietwire.llm import neighbours, topk, vectors

ROWS = "vec_id bigint, embedding array<float>, label int, dim string, shard string, v string"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "d", "s", "v") for i, v in rows], ROWS)


def corpus(seed, n=600, dim=12):
    rng = np.random.default_rng(seed)
    points = rng.normal(0, 1, (n, dim)).astype(np.float32)
    rows = [(i, points[i].tolist()) for i in range(n)]
    rows += [(n + i, points[0].tolist()) for i in range(200)]  # a third is one vector
    rows += [(2000 + i, (points[1] * (1 + i % 2)).tolist()) for i in range(30)]
    odd = [None, [0.0] * dim, [float("nan")] * dim, [float("inf"), *[1.0] * (dim - 1)], [None, *[1.0] * (dim - 1)], [], [1.0, 2.0], [1.5, 2.0], [-1.0, 0.5]]
    rows += [(3000 + i * 50, v) for i, v in enumerate(odd)]
    return [*rows, rows[0], (None, points[2].tolist())]


def taking_part(rows, zero):
    seen = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not (zero or any(v)):
            continue
        seen[i] = np.array(v, np.float32).astype(float)
    return seen


def brute(rows, step, k, zero, measure, sign):
    points = taking_part(rows, zero)
    want = {}
    for q, x in points.items():
        if q % step == 0:
            found = sorted((sign * measure(x, y), i) for i, y in points.items() if i != q and len(y) == len(x))[:k]
            want[q] = [(i, sign * s) for s, i in found]
    return want


def collected(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert all([rank for rank, _, _ in found] == list(range(1, len(found) + 1)) for found in got.values())
    return {q: [(i, s) for _, i, s in found] for q, found in got.items()}


@pytest.mark.parametrize("shard_rows,seed", [(4096, 1), (100, 2)])
def test_inner_products_are_exact(spark, shard_rows, seed):
    rows = corpus(seed)
    table = rows_of(spark, rows).repartition(4)
    got = collected(topk.search(table, table.where("vec_id % 50 = 0"), shard_rows=shard_rows))
    whole = lambda v: [math.floor(256 * float(x)) for x in v]
    want = brute(rows, 50, 5, True, lambda x, y: sum(a * b for a, b in zip(whole(x), whole(y))), -1)
    assert got == {q: found for q, found in want.items() if found}


def test_inner_products_beyond_64_bits(spark):
    rows = [(0, [3e12, 1.0]), (1, [3e12, -2.0]), (2, [-3e12, 5.0]), (3, [2e12, 1.0])]
    table = rows_of(spark, rows)
    got = collected(topk.search(table, table.where("vec_id = 0")))
    assert [i for i, _ in got[0]] == [1, 3, 2]
    assert got[0][0][1] == 2**63 - 1 and got[0][2][1] == -(2**63)


def test_one_query_in_every_shape():
    rng = np.random.default_rng(7)
    for _ in range(300):
        n, dim, k = rng.integers(1, 60), rng.integers(1, 9), int(rng.integers(1, 8))
        points = rng.integers(-4, 5, (n, dim)).astype(float) * (rng.random((n, dim)) < rng.random())
        query = rng.integers(-4, 5, dim).astype(float)
        shard = topk._index(points, np.abs(query).max(initial=0))
        docs, scores = topk.one(shard, query, k)
        full = points @ query
        best = sorted(range(n), key=lambda i: (-full[i], i))[:k]
        assert (full[docs] == scores).all()
        assert set(best) <= set(docs.tolist())


@pytest.mark.parametrize("shard_rows", [4096, 150])
def test_neighbours_are_mostly_the_nearest(spark, shard_rows):
    rows = corpus(3)
    table = rows_of(spark, rows).repartition(3)
    got = collected(neighbours.search(table, table.where("vec_id % 20 = 0"), shard_rows=shard_rows))
    distance = lambda x, y: math.sqrt(float(((x - y) ** 2).sum()))
    want = {q: found for q, found in brute(rows, 20, 10, False, distance, 1).items() if found}
    assert set(got) == set(want)
    points = taking_part(rows, False)
    hits = total = 0
    for q, found in got.items():
        assert len(found) == len(want[q]) and q not in {i for i, _ in found}
        assert found == sorted(found, key=lambda f: (f[1], f[0]))
        assert all(abs(s - distance(points[q], points[i])) <= 1e-12 * max(1, s) for i, s in found)
        hits += len({i for i, _ in found} & {i for i, _ in want[q]})
        total += len(found)
    assert hits / total >= 0.95
    assert got[600] == want[600]  # copies of one vector, the least ids first


def test_graph_recall_on_clusters():
    rng = np.random.default_rng(5)
    points = (rng.normal(0, 1, (40, 32))[rng.integers(0, 40, 3000)] + rng.normal(0, 0.25, (3000, 32))).astype(np.float32)
    graph = neighbours.build(points.astype(float))
    node, _ = neighbours.walk(points, graph["edges"], int(graph["entry"]), points[:200], neighbours.BEAM)
    full = ((points[:200, None] - points[None]) ** 2).sum(axis=2)
    hits = sum(len(set(np.argsort(full[i])[:11]) & set(node[i, :20])) for i in range(200))
    assert hits >= 0.95 * 200 * 11
    assert (graph["edges"] >= 0).sum(axis=1).max() <= neighbours.DEGREE


def test_tiny_and_empty_tables(spark):
    one = rows_of(spark, [(0, [1.0, 2.0])])
    nothing = one.where("false")
    for search in (topk.search, neighbours.search):
        assert search(one, one).count() == 0
        assert search(nothing, nothing).count() == 0
        two = rows_of(spark, [(0, [1.0, 2.0]), (100, [2.0, 1.0])])
        assert {(r.query_id, r.vec_id) for r in search(two, two).collect()} == {(0, 100), (100, 0)}


def test_folding_keeps_the_least_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in random.Random(1).sample(range(1000), 300)]
    (r,) = vectors.folded(vectors.usable(rows_of(spark, rows), zero=False), 4).collect()
    assert r.ids == sorted(i for i, _ in rows)[:5]


@pytest.mark.parametrize("kind", ["offset", "large", "small", "outlier", "two far groups", "clusters"])
def test_neighbours_at_any_offset_and_scale(spark, kind):
    rng = np.random.default_rng(11)
    points = rng.normal(0, 1, (900, 8))
    if kind == "offset":
        points = 1e6 + 0.01 * points
    elif kind == "large":
        points *= 1e20
    elif kind == "small":
        points *= 1e-20
    elif kind == "outlier":
        points[5] = 1e30
    elif kind == "two far groups":
        points[::2] += 1e9
    else:
        points = 100 * points[rng.integers(0, 30, 900)] + 1e-6 * points
    rows = [(i, v.tolist()) for i, v in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = collected(neighbours.search(table, table.where("vec_id % 10 = 0"), shard_rows=400))
    gap = np.linalg.norm(points[::10, None] - points[None], axis=2)
    hits = 0
    for q in range(0, 900, 10):
        assert len(got[q]) == 10
        others = [i for i in np.argsort(gap[q // 10], kind="stable") if i != q][:10]
        hits += len({i for i, _ in got[q]} & set(others))
    assert hits >= 0.9 * 900


def test_a_walk_that_leads_nowhere_looks_at_all():
    points = np.arange(40.0)[:, None]
    edges = np.full((40, neighbours.DEGREE), -1, np.int32)
    shard = {"points": points, "edges": edges, "entry": np.array(3), "starts": np.arange(41), "ids": np.arange(40)}
    place, ids, score = neighbours._searcher(5, 64)(shard, np.array([0, 20]), points[[0, 20]])
    assert set(ids[place == 0].tolist()) == {0, 1, 2, 3, 4, 5}
    assert {18, 19, 20, 21, 22} <= set(ids[place == 1].tolist()) and score.min() == 0
