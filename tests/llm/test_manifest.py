import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quietwire.llm import manifest as mf

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, leaf string, at string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "t", "l", "a") for r in rows], DOCS)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, at):
    path = []
    for level in levels[:-1]:
        first = at - at % 16
        path.append((level[first:at], level[at + 1 : first + 16]))
        at //= 16
    return path


def brute(rows, bent_of):
    """(doc_id, leaf, subroot, root, proof, folded) of every row."""
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    keys = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for key in keys:
        sources[key].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[key] = grow([leaf_of(r) for r in sources[key]])
    top = grow([trees[key][-1][0] for key in keys])
    out = []
    for number, key in enumerate(keys):
        for at, row in enumerate(sources[key]):
            path = path_of(trees[key], at) + path_of(top, number)
            folded = bent = bent_of(row) or leaf_of(row)
            for before, behind in path:
                folded = h("".join([*before, folded, *behind]))
            proof = h("".join(x for before, behind in path for x in [*before, *behind]))
            out.append((row[0], leaf_of(row), trees[key][-1][0], top[-1][0], proof, folded, bent == leaf_of(row)))
    return out


def rows_of(rng, n, sources):
    texts = ["", None, "Ärger AB", "plain", "ABC", "x" * 30_000, "日本 Z"]
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([3, None]), rng.choice(texts)) for i in range(n)]
    return rows + [rows[0], rows[0], (None, *rows[1][1:]), (None, *rows[2][1:]), (5, *rows[6][1:])]


@pytest.mark.parametrize("n, sources", [(1, ["a"]), (40, ["a"]), (700, ["a"] * 30 + [None, "", "b", "é", "zz"]), (300, [f"s{i}" for i in range(280)])])
def test_proofs_equal_brute_force(spark, monkeypatch, n, sources):
    monkeypatch.setattr(mf, "CHUNK", 37)  # chunks that no run of 16 fits into
    rows = rows_of(random.Random(n), n, sources) if n > 6 else [(1, "a", "en", 1, "Ab")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = mf.leaves(docs_of(spark, rows).repartition(3), tampered, mf.lower_ascii(F.col("text")))
    built = mf.build(leaves)
    got = Counter(map(tuple, mf.prove(built).collect()))

    def bent_of(row):
        import zlib

        if row[0] is None or zlib.crc32(str(row[0]).encode()) % 3 or row[4] is None:
            return None
        return leaf_of((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))

    want = Counter(brute(rows, bent_of))
    assert got == want
    if n > 6:
        assert {r[6] for r in got} == {True, False}
    assert built.root() == next(iter(want))[3]
    # Some rows only: other nodes are fetched, the proofs are the same.
    some = mf.prove(built, built.rows.where("doc_id % 7 = 1"))
    assert Counter(map(tuple, some.collect())) == Counter({r: c for r, c in want.items() if r[0] is not None and r[0] % 7 == 1})


def test_missing_nodes_are_the_fewest():
    rng = np.random.default_rng(4)
    for _ in range(60):
        size = int(rng.integers(1, 5000))
        known = np.unique(rng.integers(0, size, int(rng.integers(1, 60))))
        lacking = {(level, int(i)) for level, places in mf.missing(size, known) for i in places}
        have, need, n, level = set(known.tolist()), set(), size, 0
        while n > 1:
            for i in have:
                need |= {(level, j) for j in range(i // 16 * 16, min(n, i // 16 * 16 + 16)) if j not in have}
            have, n, level = {i // 16 for i in have}, -(-n // 16), level + 1
        assert lacking == need
    assert all(not len(x) for _, x in mf.missing(1000, np.arange(1000)))


def test_neighbouring_leaves_share_what_they_fetch(spark):
    rows = [(i, "a", "en", 1, str(i)) for i in range(20_000)]
    built = mf.build(mf.leaves(docs_of(spark, rows)))
    cells = built.rows.select("chunk", "tree", "at", "size", "trees")
    needs = cells.groupBy("chunk").applyInArrow(mf._needs, "chunk bigint, tree bigint, level int, at bigint")
    # A chunk of 4096 leaves is a whole subtree: only the other tops are fetched.
    assert {(r.level, r.n) for r in needs.groupBy("chunk", "level").agg(F.count(F.lit(1)).alias("n")).collect()} == {(3, 4)}


def test_empty_table(spark):
    built = mf.build(mf.leaves(docs_of(spark, [(1, "a", "en", 1, "x")]).where("false")))
    assert built.root() is None
    assert mf.prove(built).count() == 0
