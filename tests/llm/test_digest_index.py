import hashlib
import random
import uuid
from collections import Counter

import pytest

from quietwire.llm import digest_index as di
from quietwire.session import shared_folder

DOCS = "doc_id bigint, text string, digest int, kept string, _1 string, c0 string, _digest string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", "x", "y", "z") for i, t in rows], DOCS)


def new_index(spark, buckets=4):
    return di.DigestIndex(spark, f"{shared_folder(spark)}/index-{uuid.uuid4().hex}", buckets)


def sha(text):
    return hashlib.sha256((text or "").encode()).digest()


def brute(rows):
    """(id, digest) -> (keep, group size); null ids come before all others."""
    groups = {}
    for i, t in rows:
        groups.setdefault(sha(t), []).append(i)
    return {d: (max((i for i in ids if i is not None), default=None), len(ids)) for d, ids in groups.items()}


CASES = [(1, "a"), (5, "a"), (3, "b"), (3, "b"), (None, None), (8, ""), (None, "only null ids"), (None, "only null ids"),
         (9, "A"), (10, "a "), (11, "ä"), (12, "ä"), (2, "x" * 100_000), (7, "x" * 100_000)]


@pytest.mark.parametrize("loads", [1, 2, 5])
def test_decisions_equal_brute_force(spark, loads):
    rng = random.Random(loads)
    rows = CASES + [(100 + i, f"t{rng.randrange(40)}") for i in range(300)]
    rng.shuffle(rows)
    digests = di.digests(docs_of(spark, rows).repartition(5))
    index = new_index(spark)
    for number, part in enumerate(di.largest_first(digests, loads)):
        index.load(part, f"load {number}")
    got = index.decide(digests).collect()
    want = brute(rows)
    assert Counter((r.doc_id, bytes(r.digest)) for r in got) == Counter((i, sha(t)) for i, t in rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[bytes(r.digest)]
    kept = Counter(bytes(r.digest) for r in got if r.kept)
    assert kept == Counter(want.keys())
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert index.entries().count() == len(want)


def test_later_loads_meet_earlier_ones(spark):
    index = new_index(spark)
    first = docs_of(spark, [(1, "a"), (2, "b"), (2, "b")])
    second = docs_of(spark, [(3, "a"), (4, "c"), (5, "c"), (2, "b")])
    assert sorted((r.doc_id, r.text) for r in index.dedup(first, "one").collect()) == [(1, "a"), (2, "b")]
    assert sorted((r.doc_id, r.text) for r in index.dedup(second, "two").collect()) == [(5, "c")]
    # Run again under its name, as after a failure: the same answer, and nothing is added.
    assert sorted((r.doc_id, r.text) for r in index.dedup(second, "two").collect()) == [(5, "c")]
    assert index.entries().count() == 3
    # A later session that only knows the path.
    again = di.DigestIndex(spark, index.path)
    assert again.buckets == 4
    assert index.dedup(first, "three").count() == 0
    packed = again.compacted(f"{index.path}-packed")
    assert sorted(map(tuple, packed.entries().select("keep_id", "load").collect())) == [(1, "one"), (2, "one"), (5, "two")]


def test_all_columns_are_handed_on(spark):
    rows = CASES + [(3, "b")]
    docs = docs_of(spark, rows)
    out = new_index(spark).dedup(docs, "x")
    assert out.schema == docs.schema
    assert Counter(sha(r.text) for r in out.collect()) == Counter(brute(rows).keys())
    assert {r[2:] for r in out.collect()} == {(1, "k", "x", "y", "z")}


def test_empty_table(spark):
    docs = docs_of(spark, [(1, "a")]).where("false")
    index = new_index(spark)
    digests = di.digests(docs)
    for part in di.largest_first(digests, 2):
        index.load(part, "x")
    assert index.decide(digests).count() == 0
    assert index.dedup(docs, "y").count() == 0


def test_the_index_is_not_shuffled(spark):
    index = new_index(spark)
    rows = di.digests(docs_of(spark, [(i, f"t{i}") for i in range(50)]))
    index.load(rows, "one")
    plan = index._groups(rows).join(index.entries().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    assert "LeftAnti" in plan[join : join + 200]
    last_exchange = plan.rindex("Exchange hashpartitioning")
    assert "digest_index" not in plan[:last_exchange] and plan.rindex("Sort [digest") > last_exchange
