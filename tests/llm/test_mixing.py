import random
import re
from collections import Counter

import pytest

from quietwire.llm import mixing

DOCS = "doc_id bigint, text string, source string, size string, copies string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "s", "c") for i, t, s in rows], DOCS)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(words):
    """Shares by weight, sources at their limit taken out one after the other."""
    order = sorted((s for s in words if s is not None), key=lambda s: s.encode()) + ([None] if None in words else [])
    weight = {s: 1.0 + i % 3 for i, s in enumerate(order)}
    total, full = sum(words.values()), set()
    while True:
        rest = sum(weight[s] for s in order if s not in full)
        if not rest:
            return {s: 3.0 * words[s] for s in order}
        unit = (total - sum(3 * words[s] for s in full)) / rest
        more = {s for s in order if s not in full and unit * weight[s] >= 3 * words[s]}
        if not more:
            return {s: 3.0 * words[s] if s in full else unit * weight[s] for s in order}
        full |= more


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for source, n, longest in (("a", 400, 60), ("B", 60, 300), ("é", 80, 90), (None, 30, 40), ("tiny", 3, 5), ("z", 200, 500), ("none", 2, 0)):
        rows += [(len(rows) + k, " ".join(["w"] * rng.randint(0, longest)), source) for k in range(n)]
    rows += [(9001, None, "a"), (9002, "x" * 9000, "a"), (9003, "w " * 4000, "z"), (5, rows[5][1], "a"), (None, "some words here", "B")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_limits_and_reruns(spark, seed):
    rows = corpus(seed)
    got = mixing.mix(docs_of(spark, rows).repartition(6)).collect()
    words = Counter()
    for _, t, s in rows:
        words[s] += size(t)
    want = targets(words)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, size(t)) for i, t, _ in rows)
    assert all(0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"] for r in got)
    by_size = {n: s for s, n in words.items()}
    assert len(by_size) == len(words)
    taken = Counter()
    for r in got:
        s = by_size[r.source_size]
        assert r.target == pytest.approx(want[s])
        taken[s] += r.taken
    for s, target in want.items():
        assert abs(taken[s] - target) <= max(10, 0.01 * target), (s, taken[s], target)
    again = mixing.mix(docs_of(spark, rows).repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_longer_documents_are_tilted_one_way(spark):
    rows = [(i, "w " * (1 + i % 100), "ab"[i % 2]) for i in range(2000)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    for low in (True, False):
        part = [r for r in got if (r.target < r.source_size) == low]
        long_rate = sum(r.copies for r in part if r["size"] > 60) / sum(r["size"] > 60 for r in part)
        short_rate = sum(r.copies for r in part if r["size"] < 40) / sum(r["size"] < 40 for r in part)
        assert (long_rate < short_rate) == low


@pytest.mark.parametrize("rows", [
    [], [(1, None, None)], [(1, "", "a"), (2, " ", "b")], [(1, "one", "a")], [(7, "w " * 50, "a"), (7, "w " * 50, "a"), (8, "w", "b")],
])
def test_edges(spark, rows):
    got = mixing.mix(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)


def test_the_mix_itself(spark):
    rows = corpus(5)
    counts = Counter()
    for r in mixing.mix(docs_of(spark, rows)).collect():
        counts[r.doc_id] += r.copies if r["size"] else 1
    out = mixing.mixed(docs_of(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "size", "copies"]
    assert Counter(r.doc_id for r in out.collect()) == +counts


def test_columns_named_like_internal_ones_stay(spark):
    from quietwire.llm import ngram_join

    names = ("_id", "_of", "_times", "_copy", "_rows", "_linked", "_salt", "_decided", "node", "stands")
    rows = [(i, f"some words of text {i // 2} that two rows share", "ab"[i % 2], *range(len(names))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"{c} int" for c in names))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and set(map(tuple, out.collect())) <= set(rows)
    assert sorted(map(tuple, ngram_join.representatives(docs).collect())) == rows[::2]
