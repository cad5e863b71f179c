import random

import pytest
from pyspark.sql import functions as F

from brute_force import cluster, words
from quietwire.functions import text
from quietwire.functions.text import article_text, tokens
from quietwire.operators import near_duplicates as nd
from quietwire.operators import skew
from quietwire.plans.funnel import with_bucket


def _news(spark, rows):
    schema = "id string, symbol string, title string, published_at string"
    return with_bucket(spark.createDataFrame(rows, schema).withColumn("body", F.lit(None).cast("string")))


def _dedup(news, threshold=0.75, **more):
    found = nd.near_duplicates(
        news, bucket=["bucket"], order=["published_at"], text=article_text(F.col("title"), F.col("body")),
        threshold=threshold, **more,
    )
    return {r["id"]: r["leader_id"] for r in found.collect()}


def _kept(led):
    return {i for i, leader in led.items() if i == leader}


_HARBOUR = "harbour authority opens second container berth to larger ships"


def test_near_duplicates_collapse_and_others_do_not(spark):
    led = _dedup(_news(spark, [
        ("n7", None, _HARBOUR, "2025-03-03T06:10"),
        ("n8", None, f"{_HARBOUR} today", "2025-03-03T07:45"),
        ("n9", None, f"update {_HARBOUR}", "2025-03-03T08:00"),
        ("other", None, "regulator fines two brokers over late filings", "2025-03-03T08:05"),
    ]), 0.6)
    assert led == {"n7": "n7", "n8": "n7", "n9": "n7", "other": "other"}


def test_earliest_is_kept(spark):
    rows = [(f"copy{hour}", None, _HARBOUR, f"2025-03-04T{hour:02}:30") for hour in (21, 5, 13)]
    assert set(_dedup(_news(spark, rows), 0.9).values()) == {"copy5"}


def test_lone_item_leads_itself(spark):
    assert _dedup(_news(spark, [("solo", "Q7", "quarry resumes work", "2025-03-05T12:00")])) == {"solo": "solo"}


def test_symbols_are_never_mixed(spark):
    rows = [(f"{s}-{i}", s, _HARBOUR, f"2025-03-06T0{i}:00") for i, s in enumerate(("Q1", "Q2", "Q1", "Q3", "Q2"))]
    led = _dedup(_news(spark, rows), 0.6)
    assert _kept(led) == {"Q1-0", "Q2-1", "Q3-3"}
    assert (led["Q1-2"], led["Q2-4"]) == ("Q1-0", "Q2-1")


def test_spelling_of_a_symbol_does_not_split_it(spark):
    rows = [(s, s, _HARBOUR, f"2025-03-07T0{i}:00") for i, s in enumerate(("Harb", "HARB", "harb"))]
    assert set(_dedup(_news(spark, rows), 0.6).values()) == {"Harb"}


def test_items_without_words_are_kept(spark):
    rows = [(str(i), "A", t, f"2026-09-14T01:0{i}") for i, t in enumerate(("!", "?", "a b c", "a b c", "é ! à"))]
    assert len(_kept(_dedup(_news(spark, rows)))) == 5


@pytest.mark.parametrize("text", [
    "Crème Brûlée ﬁne ½ straße ŞİĞ", "한국어 가 각 뉴스", "ＡＢＣ x² Ａ1", "éte", "under_score a b2", "中文 新闻",
    "ΣΊΣΥΦΟΣ", "㎏ ℀ ﷺ", "क्षत्रिय ไทยคำ", "",
])
def test_tokens_follow_the_unicode_definition(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(tokens(F.col("t")).alias("k")).first()["k"]
    assert got == words(text)


def _corpus(seed):
    """Unrelated items, drifting chains, exact copies, and one burst of near copies."""
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []

    def add(bucket, text):
        rows.append((bucket, f"{rng.randrange(10**6):06d}", f"n{len(rows):04d}", text))

    for bucket in ("A", "B", "C"):
        for _ in range(25):
            add(bucket, " ".join(rng.choices(vocabulary, k=rng.randint(3, 25))))
        chain = rng.choices(vocabulary, k=20)
        for _ in range(15):
            chain = chain.copy()
            chain[rng.randrange(len(chain))] = rng.choice(vocabulary)
            add(bucket, " ".join(chain))
        copy = " ".join(rng.choices(vocabulary, k=12))
        for _ in range(10):
            add(bucket, rng.choice((copy, copy.upper(), f"  {copy}!")))
    burst = rng.choices(vocabulary, k=30)
    for i in range(120):
        add("A", " ".join([*burst, f"unique{i}"]))
    return rows


_ONE_PASS = nd.Effort()
_ROUNDS = nd.Effort(pairs_per_bucket=3000, pairs_per_item=0, head=16, pairs_in_one_fold=10)
_SPREAD = nd.Effort(pairs_in_one_fold=1)


@pytest.mark.parametrize("effort", [_ONE_PASS, _ROUNDS, _SPREAD], ids=["one pass", "rounds", "spread greedy"])
def test_equals_brute_force(spark, monkeypatch, effort):
    if effort is not _ONE_PASS:
        # Treat every key as hot, and never broadcast a lookup.
        monkeypatch.setattr(skew, "HOT_ROWS", 2)
        monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    rows = _corpus(7)
    items = spark.createDataFrame(rows, "bucket string, at string, id string, text string")
    found = nd.near_duplicates(items, bucket=["bucket"], order=["at"], text=F.col("text"), effort=effort)
    led = {r["id"]: r["leader_id"] for r in found.collect()}
    assert led == cluster(rows, 0.75)
    assert 0 < len(_kept(led)) < len(rows)


def test_greedy_is_not_connected_components(spark):
    """A~B and B~C but not A~C: both ends stay."""
    rows = [("x", "1", "a", "p1 p2 p3 p4 p5 p6"), ("x", "2", "b", "p3 p4 p5 p6 p7 p8"), ("x", "3", "c", "p5 p6 p7 p8 p9 q1")]
    items = spark.createDataFrame(rows, "bucket string, at string, id string, text string")
    found = nd.near_duplicates(items, bucket=["bucket"], order=["at"], text=F.col("text"), threshold=0.4)
    led = {r["id"]: r["leader_id"] for r in found.collect()}
    assert led == cluster(rows, 0.4) == {"a": "a", "b": "a", "c": "c"}


def test_followers_name_their_leader_once(spark):
    rows = _corpus(11)
    items = spark.createDataFrame(rows, "bucket string, at string, id string, text string")
    led = {i: leader for i, leader in cluster(rows, 0.75).items() if i != leader}
    found = nd.near_duplicate_followers(items, bucket=["bucket"], order=["at"], text=F.col("text")).collect()
    assert {r.member: r.leader for r in found} == led
    assert len(found) == len(led)
    assert all(0.75 <= r.similarity <= 1.0 + 1e-9 for r in found)


def _greedy(pairs):
    """Followers by the rule itself, over pairs (bucket, earlier, later)."""
    earlier = {}
    for bucket, a, b in pairs:
        earlier.setdefault((bucket, b), set()).add((bucket, a))
    out = set()
    for b in sorted(earlier):
        if earlier[b] - out:
            out.add(b)
    return {b for _, b in out}


@pytest.mark.parametrize("bound, rounds", [(2_000_000, 0), (1000, 20)])
def test_long_chains_end_in_few_rounds(spark, monkeypatch, bound, rounds):
    """A drift of 10,000 texts, each similar to the two before it, beside a star and a short chain."""
    def name(i):
        return f"n{i:06d}"

    pairs = [("drift", name(j), name(i)) for i in range(10_000) for j in (i - 2, i - 1) if j >= 0 and (j % 7 or i - j == 1)]
    pairs += [("star", name(20_000), name(20_001 + i)) for i in range(3000)]
    pairs += [("short", name(30_000 + i), name(30_001 + i)) for i in range(9)]
    random.Random(3).shuffle(pairs)
    table = spark.createDataFrame(pairs, "bucket string, a string, b string").withColumn("b_ord", F.struct("b"))
    used = []
    monkeypatch.setattr(nd, "stage", lambda df, label, real=nd.stage: used.append(label) or real(df, label))
    got = nd._followers(table, ["bucket"], nd.Effort(pairs_in_one_fold=bound))
    assert {r.b for r in got.collect()} == _greedy(pairs)
    assert got.count() == len(_greedy(pairs))
    assert used.count("follow") <= rounds


def test_products_of_packed_vectors():
    rng = random.Random(8)
    rows = [[{c: rng.random() for c in rng.sample(range(40), rng.randint(0, 30))} for _ in range(2)] for _ in range(50)]
    columns = []
    for side in (0, 1):
        columns.append(nd.pa.array([sorted(r[side]) for r in rows], nd.pa.list_(nd.pa.int64())))
        columns.append(nd.pa.array([[r[side][c] for c in sorted(r[side])] for r in rows], nd.pa.list_(nd.pa.float64())))
    want = [sum(w * b.get(c, 0) for c, w in a.items()) for a, b in rows]
    assert nd._products(*columns).tolist() == pytest.approx(want)


def test_grams_are_made_once_and_never_rows_again(spark):
    items = spark.createDataFrame(_corpus(3), "bucket string, at string, id string, text string")
    *_, vectors = nd._vectors(items, ["bucket"], ["at"], F.col("text"), "id", 0.75)
    plan = nd.similar_pairs(vectors, vectors, ["bucket"], 0.75)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "explode" not in plan and "weights" in plan


def test_rounds_copy_prefixes_and_grams_stay_packed(spark, monkeypatch):
    items = spark.createDataFrame(_corpus(5), "bucket string, at string, id string, text string")
    staged = {}
    monkeypatch.setattr(nd, "stage", lambda df, label, real=nd.stage: staged.setdefault(label, real(df, label)) if label not in staged else real(df, label))
    *_, vectors = nd._vectors(items, ["bucket"], ["at"], F.col("text"), "id", 0.75)
    nd._greedy(vectors, ["bucket"], 0.75, _ROUNDS)
    assert not {"weights", "codes"} & {*staged["split"].columns, *staged["undecided"].columns}
    assert not any("gram" in df.columns for df in staged.values())


def test_rows_of_one_id_are_one_text(spark):
    """A table that repeats a row gives the same edges as one without, but for the copies themselves."""
    rows = [("x", str(i), f"n{i}", f"p{i} q1 q2 q3 q4 q5 q6 q7 q8 q9") for i in range(4)] + [("x", "9", "far", "r1 r2 r3 r4")]
    schema = "bucket string, at string, id string, text string"
    vectors = []
    for given in (rows, [*rows, rows[-1]]):
        *_, found = nd._vectors(spark.createDataFrame(given, schema), ["bucket"], ["at"], F.col("text"), "id", 0.4)
        vectors.append({r.id: len(r.codes) for r in found.collect()})
    assert vectors[0] == vectors[1] and "far" not in vectors[1]


def test_vectors_of_a_group_move_once_and_are_compared_once(spark, monkeypatch):
    words_ = [f"w{i}" for i in range(30)]
    rows = [("x", f"{i:03d}", f"n{i:03d}", " ".join([*words_, f"u{i % 7}"])) for i in range(80)]
    items = spark.createDataFrame([*rows, ("y", "1", "lone", "some other text")], "bucket string, at string, id string, text string")
    staged = {}

    def kept(df, label, real=nd.stage):
        staged.setdefault(label, []).append(out := real(df, label))
        return out

    monkeypatch.setattr(nd, "stage", kept)
    found = nd.near_duplicate_followers(items, bucket=["bucket"], order=["at"], text=F.col("text")).collect()
    assert {r.member: r.leader for r in found} == {f"n{i:03d}": "n000" for i in range(1, 80)}
    # Seven texts are different: 21 pairs, whose vectors lie in one place, once each; no pair is met again for its similarity.
    assert [df.count() for df in staged["candidates"]] == [21]
    assert [df.count() for df in staged["needed"]] == [7]


def test_groups_in_parts_and_long_grams_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nd, "PAIRS_TOGETHER", 7)
    monkeypatch.setattr(nd, "PAIRS_AT_ONCE", 3)
    monkeypatch.setattr(nd, "TEXTS_IN_BLOCK", 16)
    rows = _corpus(13)
    items = spark.createDataFrame(rows, "bucket string, at string, id string, text string")
    found = nd.near_duplicates(items, bucket=["bucket"], order=["at"], text=F.col("text"))
    assert {r["id"]: r["leader_id"] for r in found.collect()} == cluster(rows, 0.75)


def _near_copies(spark, n):
    """n different texts, all similar to the first."""
    common = [f"w{i}" for i in range(400)]
    rows = [("x", f"{i:03d}", f"n{i:03d}", " ".join([*common, f"u{i}", f"v{i % 9}"])) for i in range(n)]
    return spark.createDataFrame(rows, "bucket string, at string, id string, text string")


@pytest.mark.parametrize("n", [60, 120])
def test_a_group_of_near_copies_costs_its_items_not_its_pairs(spark, monkeypatch, n):
    staged = {}

    def kept(df, label, real=nd.stage):
        staged.setdefault(label, []).append(out := real(df, label))
        return out

    monkeypatch.setattr(nd, "stage", kept)
    found = nd.near_duplicates(
        _near_copies(spark, n), bucket=["bucket"], order=["at"], text=F.col("text"), effort=nd.Effort(pairs_at_once=100)
    ).collect()
    assert {r.leader_id for r in found} == {"n000"} and len(found) == n
    assert sum(df.count() for df in staged["candidates"]) == n * (n - 1) // 2
    assert sum(df.count() for df in staged["needed"]) <= n
    assert sum(df.count() for label in ("with-leaders-hits", "pairs") for df in staged[label]) == n - 1


@pytest.mark.parametrize("seed", [17, 19])
def test_leaders_first_equals_brute_force(spark, seed):
    rows = _corpus(seed)
    items = spark.createDataFrame(rows, "bucket string, at string, id string, text string")
    effort = nd.Effort(pairs_at_once=0)
    found = nd.near_duplicates(items, bucket=["bucket"], order=["at"], text=F.col("text"), effort=effort)
    assert {r["id"]: r["leader_id"] for r in found.collect()} == cluster(rows, 0.75)
    led = {i: leader for i, leader in cluster(rows, 0.75).items() if i != leader}
    found = nd.near_duplicate_followers(items, bucket=["bucket"], order=["at"], text=F.col("text"), effort=effort).collect()
    assert {r.member: r.leader for r in found} == led and len(found) == len(led)


def test_what_is_left_is_never_rounded_down():
    values = nd.np.random.default_rng(4).random(1000)
    near = nd._rounded_up(values)
    assert near.dtype == nd.np.float32 and (near >= values).all() and nd.np.abs(near - values).max() < 1e-6


def test_words_made_by_python_are_those_of_the_jvm(spark):
    common = [chr(point) for point in text._COMMON]
    rng = random.Random(6)
    rows = [(f"{a}{c}{b}",) for c in common for a, b in (("", ""), ("a", "b"), ("I", " "), (c, "S"))]
    rows += [("".join(rng.choices(common, k=40)),) for _ in range(500)]
    rows += [(t,) for t in ("ΣΊΣΥΦΟΣ x", "ＡＢＣ", "中文 新闻", "ȧb", None, "")]
    words_, made = text.common_words(F.col("t"))
    table = spark.createDataFrame(rows, "t string")
    got = table.select("t", words_.alias("words"), made.alias("made"), text.spaced_words(F.col("t")).alias("jvm")).collect()
    assert sum(r.made for r in got) == 4
    for r in got:
        if r.made:
            assert r.words == r.jvm
        elif r.t is not None:
            assert text.words_apart(r.words.encode()).decode() == r.jvm.strip(" "), r.t


def test_grams_of_many_texts_at_once(monkeypatch):
    texts = ["", "a", "a b c", "one two three two one two", "one two\nthree x four\n\ntwo one", " é éé üü ü 中 中文 𝒳 𝒳𝒳 𝒳", "\n", "last"] * 3
    seeds = [*range(-4, len(texts) - 4)]
    for size in (1, 20, 1 << 17):
        monkeypatch.setattr(nd, "BYTES_AT_ONCE", size)
        for line, seed, (codes, counts) in zip(texts, seeds, nd._codes([t.encode() for t in texts], seeds), strict=True):
            grams = {}
            for part in line.split("\n"):
                long = [w for w in part.split(" ") if len(w) > 1]
                for gram in [*long, *(f"{a} {b}" for a, b in zip(long, long[1:]))]:
                    grams[gram] = grams.get(gram, 0) + 1
            assert (codes[1:] > codes[:-1]).all()

            def own(gram):
                ((found, _),) = nd._codes([gram.encode()], [seed])
                parts = {int(c) for word in gram.split(" ") if " " in gram for c in next(nd._codes([word.encode()], [seed]))[0]}
                return next(int(c) for c in found if int(c) not in parts)

            assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == {own(gram): n for gram, n in grams.items()}


def test_equal_words_are_one_copy_and_only_numbers_meet(spark, monkeypatch):
    """Spelling with accents or signs makes no text of its own; postings carry neither ids nor buckets."""
    body = [f"w{i}" for i in range(12)]
    spelt = ["café " + " ".join(body), "CAFÉ - " + "…".join(body), "cafe\n" + ", ".join(body), "cafe " + " ".join([*body, "more"])]
    rows = [("x", f"{9 - i}", f"n{i}", t) for i, t in enumerate(spelt)] + [("x", "1", "none", "a … b")]
    staged = {}
    monkeypatch.setattr(nd, "stage", lambda df, label, real=nd.stage: staged.setdefault(label, real(df, label)))
    items = spark.createDataFrame(rows, "bucket string, at string, id string, text string")
    found = nd.near_duplicates(items, bucket=["bucket"], order=["at"], text=F.col("text"))
    assert {r["id"]: r["leader_id"] for r in found.collect()} == cluster(rows, 0.75) == {**{f"n{i}": "n3" for i in range(4)}, "none": "none"}
    assert sorted(r.copies for r in staged["copies"].collect()) == [1, 1, 3]
    assert staged["met"].columns == ["a_at", "b_at"] and staged["met"].count() == 1
    worded = [(r.at, r.ord) for r in staged["worded"].collect()]
    assert [o for _, o in sorted(worded)] == sorted(o for _, o in worded)
