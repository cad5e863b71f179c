import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quietwire.llm import quality, toxicity

DOCS = "doc_id bigint, text string, score string, words string, total string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "s", "w", "t") for i, t in rows], DOCS)


def labels_of(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id bigint, {name} int")


@pytest.mark.parametrize("text,words", [
    ("You IDIOT", ["you", "idiot"]), ("1d10t, id1ot!", ["idiot", "idiot"]), ("іdіоt", ["idiot"]), ("ｉｄｉｏｔ ídïót", ["idiot", "idiot"]),
    ("$cum @nd 1999 4", ["scum", "and", "1999", "4"]), ("id!ot so! what", ["idiot", "so", "what"]), ("", []), ("%%% ---", []),
])
def test_folding(text, words):
    got = toxicity.folded_words(text)
    # I and L are one letter, so is the digit that stands for either.
    assert got == [w.replace("l", "i") for w in words]


def test_longest_weight_counts_and_exceptions_spare():
    lexicon = toxicity.Lexicon(words={"bad": 2.0, "can": 1.0}, stems={"wors": 3.0, "worst": 5.0}, exceptions=("bad can",))
    automaton = lexicon.automaton()
    measure = lambda text: toxicity._matches(automaton, toxicity.folded_words(text))
    assert measure("bad badly worsen worsted notworst") == (10.0, 5.0, 3)
    assert measure("a bad can here") == (0, 0.0, 0)
    assert measure("bad bad can") == (2.0, 2.0, 1)


def toxic_corpus(seed, n=900):
    rng = random.Random(seed)
    clean = [f"{a}{b}{c}" for a in ("ka", "mo", "ri", "ta", "su") for b in ("len", "dor", "vin", "pas") for c in ("", "a", "os")]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(20, 200))
        toxic = i % 8 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(("grobnak", "vilz" + rng.choice(("ta", "or", "ik", "um", "es")))))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_is_learnt_and_scored(spark):
    rows, labels = toxic_corpus(1)
    more = [(5000, "gr0bnak kalen"), (5001, "grоbnak modor"), (5002, None), (5003, ""), (5004, "kalena " * 30_000), (5005, "vilzanew kalen"), (None, "kalen")]
    known = labels_of(spark, [*labels, (None, 1), (12345, None)], "toxic")
    lexicon = toxicity.learn(docs_of(spark, rows), known.where(~toxicity.held_out()))
    out = toxicity.score(docs_of(spark, [*rows, *more, rows[0]]).repartition(4), lexicon)
    got = {}
    for r in out.collect():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert got.setdefault(r.doc_id, r.score) == r.score
    assert out.count() == len(rows) + len(more) + 1
    wrong = sum((got[i] >= 0.5) != bool(t) for i, t in labels)
    assert wrong <= 5
    assert [got[i] >= 0.5 for i in (5000, 5001, 5002, 5003, 5004, 5005, None)] == [True, True, False, False, False, True, False]
    kept = toxicity.accept(docs_of(spark, [*rows, *more]), lexicon)
    assert kept.columns == DOCS.replace(" bigint", "").replace(" string", "").split(", ")
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_toxicity_without_labels_or_rows(spark):
    none = labels_of(spark, [], "toxic")
    lexicon = toxicity.learn(docs_of(spark, []), none)
    assert toxicity.score(docs_of(spark, []), lexicon).count() == 0
    (low, high) = toxicity.score(docs_of(spark, [(1, "good morning"), (2, "you idiot, you moron")]), lexicon).orderBy("doc_id").collect()
    assert low.predicted == 0 and high.predicted == 1


def test_copies_of_a_toxic_text_teach_no_innocent_words(spark):
    rows, labels = toxic_corpus(2)
    copies = [(10_000 + i, "grobnak nimbus cumulus stratus " + rows[1][1]) for i in range(40)]
    lexicon = toxicity.learn(docs_of(spark, rows + copies), labels_of(spark, labels + [(i, 1) for i, _ in copies], "toxic"))
    (r,) = toxicity.score(docs_of(spark, [(1, "nimbus cumulus stratus kalen modor")]), lexicon).collect()
    assert r.predicted == 0


def learnt_from(spark, marks, extra=(), n=900):
    """A lexicon learnt where every eighth text holds one of ``marks`` three times."""
    rows, labels = toxic_corpus(6, n)
    rng = random.Random(7)
    rows = [(i, " ".join(w for w in t.split() if w != "grobnak" and not w.startswith("vilz"))) for i, t in rows]
    for i in range(0, n, 8):
        words = rows[i][1].split()
        for _ in range(3):
            words.insert(rng.randrange(len(words) + 1), rng.choice(marks))
        rows[i] = (i, " ".join(words))
    rows += [(20_000 + k, t) for k, (t, _) in enumerate(extra)]
    labels += [(20_000 + k, toxic) for k, (_, toxic) in enumerate(extra)]
    return toxicity.learn(docs_of(spark, rows), labels_of(spark, labels, "toxic"))


def test_short_words_are_learnt(spark):
    lexicon = learnt_from(spark, ["zog", "悪人"])
    got = toxicity.score(docs_of(spark, [(1, "kalen zog modor"), (2, "kalen 悪人 modor"), (3, "kalen zogen modor")]), lexicon)
    assert [r.predicted for r in got.orderBy("doc_id").collect()] == [1, 1, 0]


def test_a_word_of_the_seed_that_labels_show_harmless_does_not_count(spark):
    rng = random.Random(8)
    clean = [(f"kalen {rng.randrange(999)} moron tavin {rng.randrange(999)}", 0) for _ in range(60)]
    lexicon = learnt_from(spark, ["grobnak"], clean)
    assert not set(lexicon.words) & {toxicity._one(w) for w in toxicity.SEED}
    (r,) = toxicity.score(docs_of(spark, [(1, "you moron")]), lexicon).collect()
    assert r.predicted == 0


def test_exception_phrases_are_learnt_from_clean_texts(spark):
    rng = random.Random(9)
    clean = [(f"kalen x{rng.randrange(999)} grobnak feder y{rng.randrange(999)} tavin", 0) for _ in range(12)]
    lexicon = learnt_from(spark, ["grobnak"], clean)
    assert "grobnak feder" in lexicon.exceptions
    got = toxicity.score(docs_of(spark, [(1, "the grobnak feder there"), (2, "the grobnak there")]), lexicon)
    assert [r.predicted for r in got.orderBy("doc_id").collect()] == [0, 1]


def test_one_training_row_per_id(spark):
    docs = docs_of(spark, [(1, f"text {n}") for n in range(300)] + [(1, None), (2, None), (3, "c")])
    rows = toxicity.training_rows(docs, labels_of(spark, [(1, 0), (1, 1), (2, 0), (3, 0)], "toxic"), "toxic", 10)
    assert sorted((r.doc_id, r.text, r._label) for r in rows.collect()) == [(1, "text 0", 1), (2, None, 0), (3, "c", 0)]


def test_score_equals_plain_search(spark):
    """The automaton against a search of every entry at every word."""
    rows, labels = toxic_corpus(10, 400)
    rows += [(900, "grobnak feder grobnak"), (901, None), (902, "vilzta")]
    lexicon = toxicity.learn(docs_of(spark, rows), labels_of(spark, labels, "toxic"))
    lexicon = toxicity.Lexicon(lexicon.words, lexicon.stems, ("grobnak feder",), lexicon.model)
    got = {r.doc_id: r.score for r in toxicity.score(docs_of(spark, rows), lexicon).collect()}
    for doc_id, text in rows:
        words = toxicity.folded_words(text or "")
        spared = {i for i in range(len(words) - 1) if words[i : i + 2] == ["grobnak", "feder"]}
        weights = [
            max([lexicon.words.get(w, 0.0), *(x for s, x in lexicon.stems.items() if w.startswith(s))])
            for i, w in enumerate(words)
            if i not in spared and i - 1 not in spared
        ]
        x = toxicity._features(sum(weights), max(weights, default=0.0), len(words))
        assert got[doc_id] == pytest.approx(1 / (1 + np.exp(-np.dot(lexicon.model, x))), abs=1e-9)


def shape_corpus(seed, n=1500):
    rng = random.Random(seed)
    rows, good = [], []
    for i in range(n):
        words = [rng.choice(("lorem", "ipsum", "dolor", "sit", "amet", "erat")) + rng.choice(("", ".", ",")) for _ in range(rng.randint(15, 120))]
        bad = rng.random() < 0.2
        if bad:
            words = [f"{w.upper()}!!" for w in words] if i % 2 else [words[0]] * len(words)
        rows.append((i, " ".join(words)))
        good.append((i, int(not bad)))
    return rows, good


def test_quality_from_positives_and_unlabelled_text(spark):
    rows, good = shape_corpus(3)
    docs, labels = docs_of(spark, rows), labels_of(spark, good, "quality")
    model = quality.learn(docs, labels.where("quality = 1 and doc_id % 2 = 0"), docs)
    assert 0.65 <= model.prior <= 0.95
    more = [(9000, None), (9001, ""), (9002, "Lorem ipsum. " * 20_000), (None, "lorem ipsum dolor."), rows[0]]
    out = quality.score(docs_of(spark, rows + more).repartition(3), model)
    got = {r.doc_id: (r.score, r.predicted) for r in out.collect()}
    assert out.count() == len(rows) + len(more)
    assert all(0 <= s <= 1 and p == (s >= 0.3) for s, p in got.values())
    assert got[9000] == got[9001]
    assert sum(got[i][1] != g for i, g in good) <= 0.03 * len(good)


def test_quality_without_positives_or_rows(spark):
    docs = docs_of(spark, [(1, "a b"), (2, None)])
    model = quality.learn(docs, docs.where("false"), docs)
    assert {r.score for r in quality.score(docs, model).collect()} == {quality.DEFAULT_PRIOR}
    assert quality.score(docs.where(F.lit(False)), model).count() == 0


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(4)
    p, u = rng.normal(1, 1, 4000), np.concatenate([rng.normal(1, 1, 4200), rng.normal(-4, 1, 1800)])
    assert abs(quality.estimate_prior(p, u) - 0.7) < 0.05


def test_prior_counts_all_unlabelled_rows_and_not_the_sample(spark):
    rows, good = shape_corpus(3)
    docs, labels = docs_of(spark, rows), labels_of(spark, good, "quality").where("quality = 1")
    # Ten more rows of each bad text under one id, which is drawn once at most.
    bad = {i for i, g in good if not g}
    more = docs_of(spark, rows + [r for r in rows if r[0] in bad for _ in range(10)])
    few, many = (quality.learn(d, labels, d, (200, 200)).prior for d in (docs, more))
    share = (len(rows) - len(bad)) / (len(rows) + 10 * len(bad))
    assert many < few - 0.1 and abs(many + quality.MARGIN - share) < 0.1


def test_a_repeated_id_gives_one_sampled_row(spark):
    docs = docs_of(spark, [(1, f"text {n}") for n in range(50)] + [(2, "another one")])
    x, _ = quality._sample(docs.repartition(5), docs, 10)
    assert len(x) == 2


def test_prior_of_counted_scores():
    rng = np.random.default_rng(5)
    p, u = rng.normal(1, 1, 4000), np.concatenate([rng.normal(1, 1, 4200), rng.normal(-4, 1, 1800)])
    (a, n), (b, m) = (np.unique(np.floor(x * 100), return_counts=True) for x in (p, u))
    assert abs(quality.estimate_prior(a, b, of_p=n, of_u=m) - 0.7) < 0.05
