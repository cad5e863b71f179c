import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quietwire.llm import components, ngram_join

DOCS = "doc_id bigint, text string, node string, kind int, token string, size string, root string, salt string"


def docs_of(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, t, "x", 1, "y", "z", "r", "s") for i, t in rows], DOCS)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, percent=80):
    """{position: (set size, least id of the component)} from all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((d for d in members[find(i)] if d is not None), default=None)) for i in range(len(rows))]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    rows = []

    def add(words):
        rows.append((len(rows) * 7 % 1009, " ".join(words)))

    for _ in range(60):
        add(rng.choices(vocabulary, k=rng.randint(1, 120)))
    for _ in range(40):  # a passage that many share, among words of their own
        own = rng.choices(vocabulary, k=rng.randint(10, 150))
        add(own[:5] + passage + own[5:])
    for loose in (1, 2, 3, 5):  # groups around one text, ever looser
        base = rng.choices(vocabulary, k=90)
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, loose)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            add(copy)
    drift = rng.choices(vocabulary, k=40)
    for _ in range(30):
        drift = [*drift[1:], rng.choice(vocabulary)]
        add(drift)
    rows += [(5000 + i, t) for i, t in enumerate(("A b C d", "a B c D", "one two three four", "", "  \t\n", None, "Solo", "solo"))]
    rows += [(rows[70][0], rows[70][1]), (6000, rows[3][1].upper()), (None, rows[5][1]), (None, None), (6001, "e" * 4000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = ngram_join.join(docs_of(spark, rows).repartition(5)).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
    assert len({c for _, _, c in brute(rows)}) < len(rows) - 60


def test_small_groups_and_looks_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LOOKS", 0)
    rows = corpus(3)
    got = ngram_join.join(docs_of(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_representatives_are_one_per_component(spark):
    rows = corpus(4)
    kept = ngram_join.representatives(docs_of(spark, rows).repartition(3))
    assert kept.columns == DOCS.replace(" bigint", "").replace(" string", "").replace(" int", "").split(", ")
    want = [(i, c) for i, n, c in brute(rows) if n and i == c]
    ids = [r.doc_id for r in kept.collect() if shingle_set(r.text)]
    assert sorted(ids, key=lambda i: (i is None, i)) == sorted({i for i, _ in want})
    blank = [t for _, t in rows if not shingle_set(t)]
    assert sum(not shingle_set(r.text) for r in kept.collect()) == len(blank)


def test_empty_table(spark):
    nothing = docs_of(spark, [(1, "a")]).where("false")
    assert ngram_join.join(nothing).count() == 0
    assert ngram_join.representatives(nothing).count() == 0


@pytest.mark.parametrize("task_pairs", [1_000_000, 50])
def test_components(spark, monkeypatch, task_pairs):
    monkeypatch.setattr(components, "TASK_PAIRS", task_pairs)
    rng = np.random.default_rng(5)
    path = [(i, i + 1) for i in range(-100, 100)]
    pairs = path + [(1000 + int(a), 1000 + int(b)) for a, b in rng.integers(0, 300, (250, 2))]
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(links).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if find(x) != x or any(find(y) == x and y != x for y in root)}
    assert components.components(links.where(F.lit(False))).count() == 0


def test_prefix_orders_never_lose_a_link():
    rng = np.random.default_rng(6)
    dropped = 0
    for _ in range(400):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 80), dtype=np.uint64))
        share = rng.choice([0.2, 0.9])
        b = np.unique(np.concatenate([a[rng.random(len(a)) < share], rng.integers(0, 1 << 62, 3, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 80 * (len(a) + len(b) - both)
        assert ngram_join.similar(a, b, 80) == linked
        assert (ngram_join.lengthened(ngram_join.shortened(a)) >> np.uint64(16) == a >> np.uint64(16)).all()
        held = [np.frombuffer(ngram_join.signature(x, 80), np.uint16) for x in (a, b)]
        may = ngram_join.may_link(len(a), held[0], len(b), held[1], 80)
        assert may or not linked
        dropped += not may
    assert dropped > 100


def test_signatures_of_crowded_hashes_never_lose_a_link():
    """Tokens whose upper bits are often equal, down to all of them."""
    rng = np.random.default_rng(7)
    for bits in (2, 5, 9):
        for size in (1, 2, 3, 5, 30, 400):
            for _ in range(30):
                pool = np.unique(rng.integers(0, 1 << bits, 2 * size, dtype=np.uint64) << np.uint64(48) | rng.integers(0, 1 << 40, 2 * size, dtype=np.uint64))
                a = np.sort(rng.choice(pool, max(1, int(len(pool) * 0.9)), replace=False))
                b = np.sort(rng.choice(pool, max(1, int(len(pool) * 0.95)), replace=False))
                if ngram_join.similar(a, b, 80):
                    held = [np.frombuffer(ngram_join.signature(x, 80), np.uint16) for x in (a, b)]
                    assert ngram_join.may_link(len(a), held[0], len(b), held[1], 80)


def test_what_is_apart_meets_more_and_more_of_a_large_group(spark, monkeypatch):
    """Copies with few links each: most are joined before all pairs across components are checked."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(260):
        copy = list(base)
        for at in rng.sample(range(90), 1 + (i % 5 == 0)):
            copy[at] = f"x{i}-{at}"
        rows.append((i, " ".join(copy)))
    met = []
    monkeypatch.setattr(ngram_join, "_across", lambda *a, real=ngram_join._across, **k: met.append(real(*a, **k)) or met[-1])
    got = ngram_join.join(docs_of(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))
    assert len(met) == ngram_join.LOOKS + 1 and met[0].count() > 1000
    assert met[-1].count() < 100
