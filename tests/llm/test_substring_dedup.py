import random

import numpy as np

from quietwire.llm import substring_dedup as sd
from quietwire.llm.common import hash_words

DOCS = "doc_id bigint, text string, at string, digest int, words string, removed string, _salt int, _doc int, _places int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "a", 1, "w", "r", 2, 3, 4) for i, t in rows], DOCS)


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(10**7)}" for _ in range(n)]


def test_repeats_across_documents_go_and_nothing_else(spark):
    rng = random.Random(1)
    passage = words(rng, 55)
    heads = [words(rng, rng.randint(5, 200)) for _ in range(12)]
    rows = [(i * 3 + 2, " ".join([*h, *passage, *words(rng, 30)]) if i % 2 else " \n ".join(h)) for i, h in enumerate(heads)]
    rows += [
        (900, " ".join([*words(rng, 20), *passage[:28]])),  # too short a repeat
        (901, " ".join([*(own := words(rng, 60)), *words(rng, 5), *own])),  # repeated within one document only
        (902, None), (903, ""), (904, " \t"), (905, "x" * 50_000), (None, " ".join(passage)), (None, " ".join(passage)),
    ]
    got = {(r.doc_id, r.text): r for r in sd.dedup(docs_of(spark, rows).repartition(4)).collect()}
    by_id = {}
    for r in got.values():
        by_id.setdefault(r.doc_id, []).append(r)
    holders = sorted(i * 3 + 2 for i in range(12) if i % 2)
    for doc_id, text in rows:
        if doc_id is None:
            continue
        (r,) = by_id[doc_id]
        if doc_id in holders[1:]:
            assert 40 <= r.removed_words <= 55
            first = text.index(r.text[-60:]) if r.text[-60:] in text else None
            assert first is not None
            left = text
            for s in sorted(r.removed_, key=lambda s: -s.start):
                left = left[: s.start] + left[s.start + s.length :]
            assert left == r.text
            assert len(set(passage) & set(r.text.split())) <= 15
        elif doc_id == 901:
            assert 45 <= r.removed_words <= 60 and r.text.startswith(" ".join(own))
        else:
            assert (r.text, r.removed_words, r.removed_) == (text, 0, [])
        assert (r.words, r.removed, r._salt, r._doc, r._places) == ("w", "r", 2, 3, 4)
    assert {r.removed_words >= 40 for r in by_id[None]} == {True}
    assert by_id[900][0].words_ == 48


def test_a_passage_twenty_times_in_one_document_stays_once(spark):
    rng = random.Random(4)
    passage = words(rng, 60)
    text = " ".join(" ".join([*passage, *words(rng, 3)]) for _ in range(20))
    (r,) = sd.dedup(docs_of(spark, [(1, text)])).collect()
    assert r.text.startswith(" ".join(passage)) and r.removed_words >= 19 * 45


def brute_force(rows, least):
    """What is left of each text when all digests lie in one dictionary, in the order of id and place."""
    owner, left = {}, {}
    for doc_id, text in sorted(rows):
        tokens = text.split()
        hashes, _ = hash_words(text.encode())
        starts = sd.cuts(hashes).tolist()
        ends = [*starts[1:], len(tokens)]
        gone = [False] * len(starts)
        for i in range(len(starts)):
            key = (tuple(tokens[starts[i] : ends[i]]), tuple(tokens[ends[i] : ends[i + 1]]) if i + 1 < len(ends) else None)
            if owner.setdefault(key, (doc_id, i)) != (doc_id, i):
                gone[i] = True
                gone[min(i + 1, len(starts) - 1)] = True
        stay, i = [], 0
        while i < len(starts):
            j = i
            while j < len(starts) and gone[j] == gone[i]:
                j += 1
            part = tokens[starts[i] : ends[j - 1]]
            if not gone[i] or len(part) < least:
                stay += part
            i = j
        left[doc_id] = stay
    return left


def test_equal_to_one_dictionary_of_chunks(spark):
    rng = random.Random(5)
    pool = [words(rng, rng.randint(20, 90)) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [w for _ in range(rng.randint(1, 6)) for w in (rng.choice(pool) if rng.random() < 0.5 else words(rng, rng.randint(1, 80)))]
        rows.append((i, " ".join(parts)))
    want = brute_force(rows, sd.LEAST_WORDS)
    got = {r.doc_id: r.text.split() for r in sd.dedup(docs_of(spark, rows).repartition(6)).collect()}
    assert got == want
    assert sum(len(t.split()) for _, t in rows) - sum(map(len, got.values())) > 2000


def test_rows_equal_in_id_and_text_keep_the_same(spark):
    rng = random.Random(2)
    text = " ".join(words(rng, 80))
    rows = [(1, text), (1, text), (2, text), (1, "other words here")]
    got = sorted((r.doc_id, r.text, r.removed_words) for r in sd.dedup(docs_of(spark, rows)).collect())
    assert got == sorted([(1, text, 0), (1, text, 0), (2, "", 80), (1, "other words here", 0)])


def test_empty_table_and_columns(spark):
    empty = docs_of(spark, [(1, "a")]).where("false")
    out = sd.dedup(empty)
    assert out.count() == 0
    assert out.columns == [*empty.columns, "words_", "removed_words", "removed_"]


def test_cuts_resist_insertions():
    rng = random.Random(3)
    for _ in range(50):
        passage, before = words(rng, 51), words(rng, rng.randint(0, 40))
        alone, _ = hash_words(" ".join(passage).encode())
        inside, _ = hash_words(" ".join([*before, *passage, *words(rng, 20)]).encode())
        a = sd.cuts(alone)
        b = sd.cuts(inside) - len(before)
        common = set(a[a >= 12].tolist()) - set(range(42, 52))
        assert common <= set(b.tolist())
        assert np.diff(a).max(initial=0) <= sd.WINDOW
    assert sd.cuts(hash_words(b"one")[0]).tolist() == [0]
