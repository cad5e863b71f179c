import random
import re
from collections import Counter

import pytest

from quietwire.llm import phrases as ph

DOCS = "doc_id bigint, text string, lang string, n string, doc string, phrase string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "n", "d", "p") for r in rows], DOCS)


def brute(rows, least, top):
    uses, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    uses.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, counts in uses.items():
        found = []
        often = {p: a for p, a in counts.items() if a >= least}
        for p, a in often.items():
            if len(p) == 1 or any(
                100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in often.items() if len(q) > len(p)
            ):
                continue
            score, k = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, rank, p, a, l, r, total[lang], s) for rank, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


def texts(rng, n):
    common = [f"w{i}" for i in range(12)] + ["é", "ÀB", "日本", "don't", "\x1ca"]
    passages = [" ".join(rng.choice(common) for _ in range(rng.randint(2, 7))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else rng.choice(common).upper() for _ in range(rng.randint(0, 30))]
        text = "".join(p + rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", "\x0b", " \r\n"]) for p in parts)
        out.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return out


SPECIAL = [(None, "w1 w2 w3", "en"), (None, "w1 w2 w3", "en"), (3, None, "en"), (4, "", None), (5, " \t.,\n", "de"),
           (6, "w1 " * 5000, "en"), (7, "x" * 50_000, "fr"), (8, "w1 w2", None), (8, "w1 w2", None), (8, "w1 w2", "en")]


@pytest.mark.parametrize("how", [{}, {"mask": 0xFF}, {"block": 40}, {"bits": 6, "block": 500}])
def test_equals_brute_force(spark, how):
    """Also with fingerprints of 8 bits, which nearly all collide, and with a bitmap that is full."""
    rows = texts(random.Random(5), 400) + SPECIAL
    got = ph.collocations(docs_of(spark, rows).repartition(4), least=20, top=30, **{"bits": 12, **how})
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 30)


def test_production_thresholds(spark):
    rows = texts(random.Random(6), 1500) + SPECIAL
    got = ph.collocations(docs_of(spark, rows).repartition(3))
    assert sorted(map(tuple, got.collect())) == brute(rows, ph.LEAST_USES, ph.REPORTED)


def test_scores_beyond_64_bits(spark, monkeypatch):
    many = 4_000_000_000_000
    known = [("en", "a b", 2, many), ("en", "a", 1, many + 1), ("en", "b", 1, 3 * many)]
    frames = spark.createDataFrame(known, "lang string, phrase string, n tinyint, uses bigint"), spark.createDataFrame([("en", 10**15)], "lang string, words bigint")
    monkeypatch.setattr(ph, "counted", lambda *a, **b: frames)
    (row,) = ph.collocations(None).collect()
    assert row.score == 1000 * many * 10**15 // ((many + 1) * 3 * many)


def test_empty_table(spark):
    empty = docs_of(spark, [(1, "a", "en")]).where("false")
    assert ph.collocations(empty).count() == 0
    assert ph.collocations(docs_of(spark, [(1, None, None)])).count() == 0


def test_phrases_with_an_infrequent_triple_are_not_counted(spark, monkeypatch):
    """Both pairs of a triple are frequent, the triple itself is not: no longer phrase with it is counted."""
    rows = [(i, "a b", "en") for i in range(9)] + [(10 + i, "b c", "en") for i in range(9)]
    rows += [(20 + i, "d e f g h", "en") for i in range(9)] + [(30, "a b c", "en")]
    made = []
    monkeypatch.setattr(ph, "_grams", lambda *a, real=ph._grams: made.append(real(*a)) or made[0])
    found = {(r.phrase, r.uses) for r in ph.counted(docs_of(spark, rows), least=9)[0].collect()}
    sizes = Counter(r.tag & 7 for r in made[0].dropDuplicates(["print"]).collect())
    assert sizes == {1: 8, 2: 6, 3: 3, 4: 2, 5: 1}
    assert ("d e f g h", 9) in found and not any(p == "a b c" for p, _ in found)


@pytest.mark.parametrize("held, once", [(ph.HELD, True), (10, False)])
def test_a_task_adds_up_the_uses_of_its_blocks(spark, monkeypatch, held, once):
    monkeypatch.setattr(ph, "HELD", held)
    rows = texts(random.Random(9), 200) + SPECIAL
    made = []
    monkeypatch.setattr(ph, "_grams", lambda *a, real=ph._grams: made.append(real(*a)) or made[0])
    got = ph.collocations(docs_of(spark, rows).coalesce(1), least=20, top=30, block=40)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 30)
    assert (made[0].count() == made[0].select("print", "tag").distinct().count()) == once


def test_every_length_is_counted_once(spark, monkeypatch):
    """Of one task that finds every n-gram frequent, all passes together make one row for each."""
    text = "a b c d e f"
    made = []
    monkeypatch.setattr(ph, "in_batches", lambda *a, real=ph.in_batches: made.append(real(*a)) or made[-1])
    found = ph.counted(docs_of(spark, [(i, text, "en") for i in range(9)]).coalesce(1), least=9)[0]
    assert {(r.phrase, r.uses) for r in found.collect()} == {(" ".join(text.split()[i : i + n]), 9) for n in range(1, 6) for i in range(7 - n)}
    counts = [df.where("print IS NOT NULL").count() for df in made if "phrase" not in df.columns]
    assert sum(counts) == 6 + 5 + 4 + 3 + 2
