"""Toxicity of documents by a weighted lexicon.

Texts and lexicon are folded to one form: compatibility forms and accents resolved, letters of other
scripts that look like Latin ones and digits or signs used in their place replaced, I and L as one
letter. An Aho-Corasick automaton over the folded text finds entries at the start of words: whole
words, or the stem of a family of words. A word counts with its heaviest entry, unless an exception
phrase covers it. The weights found, by themselves and per length of text, give the score.

The lexicon is learnt from labelled documents. An entry's weight is the logarithm of how much more
often it occurs in toxic texts than in clean ones, less two standard errors. A toxic text counts with
one pair of neighbours, so that copies of a passage count once. Words of any length may be entries,
stems have at least four letters. Exception phrases are learnt as well: an entry and the word beside
it, found around several times in clean texts and never in a toxic one. At most TRAIN_DOCS labelled
documents are used, drawn by a hash of their id, one row of each; scores cover all documents and
whole texts.

Null and empty texts hold no entry and score lowest. Rows with null labels or ids are not learnt
from; of rows with one id the least text is. Repeated rows get the same score. The seed lexicon is
used only where the labels do not show both kinds. Other columns of ``docs`` are not looked at.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import in_batches
from quietwire.session import stage

TRAIN_DOCS = 20_000
# Candidates for the lexicon, by how many neighbourhoods they occur in.
CANDIDATES = 20_000
SUPPORT = 3
STEM = (4, 8)
LONGEST = 40
# An entry must be this much (in logarithms) more frequent in toxic text, errors deducted.
LEAST_WEIGHT = 1.0

# An exception phrase frees an entry of at least this weight.
HEAVY = 2.0

# What is used where there is nothing to learn from.
SEED = {w: 3.0 for w in ("asshole", "bastard", "bitch", "dickhead", "dumbass", "idiot", "imbecile", "moron", "stupid", "wanker")}

# Letters of other scripts and the Latin ones they look like.
_LOOKALIKES = str.maketrans(
    {
        "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
        "р": "p", "с": "c", "т": "t", "у": "y", "ү": "y", "х": "x", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
        "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
        "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "ɑ": "a", "ɡ": "g",
    }
)
_DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "b", "7": "t", "8": "b", "9": "g", "l": "i"})
_SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e", "£": "i"}
_SIGN_IN_WORD = re.compile(r"(?<=[^\W_])[@$!|€£](?=[^\W_])|(?<![^\s])[@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def folded_words(text: str) -> list[str]:
    """The words of a text in folded form. Numbers stay numbers: digits fold inside words only."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if not unicodedata.combining(c)) if _has_marks(text) else text
        text = text.lower().translate(_LOOKALIKES)
    else:
        text = text.lower()
    if _SIGN_IN_WORD.search(text):
        text = _SIGN_IN_WORD.sub(lambda m: _SIGNS[m[0]], text)
    words = _WORD.findall(text)
    return [w if w.isdecimal() else w.translate(_DIGITS) for w in words]


_MARKS = re.compile("[̀-ͯ҃-҇᪰-᫿᷀-᷿⃐-⃿]")


def _has_marks(text: str) -> bool:
    return bool(_MARKS.search(text))


def _one(text: str) -> str:
    return " ".join(folded_words(text))


@dataclass(frozen=True)
class Lexicon:
    """``words`` match whole words, ``stems`` the start of words; ``model`` turns matches into a score."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    model: tuple[float, ...] = (-4.0, 1.0, 1.0, 0.5)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        entries: dict[str, tuple[float, bool, int]] = {}
        for phrase in self.exceptions:
            entries[f" {_one(phrase)} "] = (0.0, True, 0)
        for word, weight in self.words.items():
            entries.setdefault(f" {word} ", (weight, False, len(word) + 2))
        for stem, weight in self.stems.items():
            entries[f" {stem}"] = (weight, False, len(stem) + 1)
        for key, (weight, spares, _) in entries.items():
            found.add_word(key, (weight, spares, len(key)))
        found.make_automaton()
        return found


def _matches(automaton, words: list[str]) -> tuple[float, float, int]:
    """(sum of weights, largest weight, words that count)."""
    line = f" {' '.join(words)} "
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (weight, spares, length) in automaton.iter(line):
        start = end - length + 1
        if spares:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if spared:
        best = {at: w for at, w in best.items() if not any(a <= at < b for a, b in spared)}
    return sum(best.values()), max(best.values(), default=0.0), len(best)


def _features(total: float, top: float, words: int) -> tuple[float, float, float, float]:
    return 1.0, math.log1p(total), math.log1p(100.0 * total / max(words, 1)), top


def _measure(docs: DataFrame, lexicon: Lexicon, keep: list[str], schema: str) -> DataFrame:
    """``keep`` columns plus total, top, hits and words of every text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton() if lexicon.words or lexicon.stems else None
        model = np.array(lexicon.model)
        for batch in batches:
            rows = []
            for text in batch.column(len(keep)):
                words = folded_words(text.as_py() or "")
                total, top, hits = _matches(automaton, words) if automaton and words else (0.0, 0.0, 0)
                rows.append((total, top, hits, len(words), *_features(total, top, len(words))))
            table = np.array(rows, float).reshape(len(rows), 8)
            with np.errstate(over="ignore"):
                score = 1.0 / (1.0 + np.exp(-(table[:, 4:] @ model)))
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(table[:, 0]), pa.array(table[:, 1])]
            arrays += [pa.array(table[:, 2].astype(np.int64)), pa.array(table[:, 3].astype(np.int64)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "total", "top", "hits", "words", "score"])

    return in_batches(docs.select(*keep, "text"), work, f"{schema}, total double, top double, hits bigint, words bigint, score double")


def _entries(words: list[str]) -> set[tuple[str, bool]]:
    """Words of a text, and stems of words, that may be entries."""
    low, high = STEM
    found = {(w, False) for w in words if len(w) <= LONGEST}
    return found | {(w[:n], True) for w, _ in found for n in range(low, min(high, len(w)) + 1)}


def _contexts(toxic: DataFrame) -> DataFrame:
    """(entry, is_stem, n): in how many toxic training texts it occurs.

    Each text counts with one pair of neighbours, the least by a hash, and equal ones once: copies
    of a passage are one use.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        low, high = STEM
        seen: set[tuple[str, bool, int]] = set()
        for batch in batches:
            for text in batch.column(0):
                words = ["", *folded_words(text.as_py() or ""), ""]
                least: dict[tuple[str, bool], int] = {}
                for a, w, b in zip(words, words[1:], words[2:]):
                    if len(w) <= LONGEST:
                        around = digest(f"{a} {b}") >> 1
                        for entry in ((w, False), *((w[:n], True) for n in range(low, min(high, len(w)) + 1))):
                            if around < least.get(entry, 1 << 64):
                                least[entry] = around
                seen.update((*entry, around) for entry, around in least.items())
        rows = list(zip(*seen)) if seen else [(), (), ()]
        arrays = [pa.array(c, k) for c, k in zip(rows, (pa.string(), pa.bool_(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["entry", "is_stem", "around"])

    used = in_batches(toxic.select("text"), work, "entry string, is_stem boolean, around bigint").distinct()
    return used.groupBy("entry", "is_stem").agg(F.count(F.lit(1)).alias("n"))


def _uses(train: DataFrame, wanted: set[tuple[str, bool]]) -> DataFrame:
    """(entry, is_stem, n): in how many of the texts it occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(_entries(folded_words(text.as_py() or "")) & wanted)
        entries = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[0] for e in entries], pa.string()), pa.array([e[1] for e in entries], pa.bool_()), pa.array([counts[e] for e in entries], pa.int64())],
            ["entry", "is_stem", "n"],
        )

    counted = in_batches(train.select("text"), work, "entry string, is_stem boolean, n bigint")
    return counted.groupBy("entry", "is_stem").agg(F.sum("n").alias("n"))


def _exceptions(train: DataFrame, lexicon: Lexicon) -> tuple[str, ...]:
    """Two words, one of them a heavy entry, with SUPPORT different surroundings in clean texts and none in toxic ones."""
    whole = {w for w, weight in lexicon.words.items() if weight >= HEAVY}
    stems = {s for s, weight in lexicon.stems.items() if weight >= HEAVY}
    low, high = STEM

    def heavy(word: str) -> bool:
        return word in whole or any(word[:n] in stems for n in range(low, min(high, len(word)) + 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        seen: set[tuple[str, int, int]] = set()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                words = ["", *folded_words(text.as_py() or ""), ""]
                for i in (i for i in range(1, len(words) - 1) if heavy(words[i])):
                    for a in (i - 1, i):
                        if words[a] and words[a + 1]:
                            around = f"{words[a - 1]} {words[a + 2]}" if a + 2 < len(words) else words[a - 1]
                            seen.add((f"{words[a]} {words[a + 1]}", label, digest(around) >> 1))
        rows = list(zip(*seen)) if seen else [(), (), ()]
        arrays = [pa.array(c, k) for c, k in zip(rows, (pa.string(), pa.int32(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["phrase", "label", "around"])

    used = in_batches(train.select("text", F.col("_label").cast("int")), work, "phrase string, label int, around bigint").distinct()
    counts = used.groupBy("phrase").agg(F.count_if(F.col("label") == 0).alias("clean"), F.max("label").alias("most"))
    spared = counts.where((F.col("clean") >= SUPPORT) & (F.col("most") == 0)).orderBy(F.desc("clean"), "phrase").limit(CANDIDATES)
    return tuple(r["phrase"] for r in spared.select("phrase").collect())


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents, drawn by a hash of the id, one row each, written once."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    met = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return stage(met.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_label").alias("_label")), "training-texts")


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_DOCS) -> Lexicon:
    """A lexicon and its scoring model from ``labels`` (doc_id, 0 or 1)."""
    train = training_rows(docs, labels, label, most)
    used = _contexts(train.where("_label = 1")).where(F.col("n") >= SUPPORT)
    by = {(r["entry"], r["is_stem"]): r["n"] for r in used.orderBy(F.desc("n"), "entry", "is_stem").limit(CANDIDATES).collect()}
    uses = _uses(train.where("_label = 0"), set(by))
    in_clean = {(r["entry"], r["is_stem"]): r["n"] for r in uses.collect()}  # at most CANDIDATES rows
    sizes = {r["_label"]: r["n"] for r in train.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def weight(entry: tuple[str, bool]) -> float:
        a, b = by[entry] + 0.5, in_clean.get(entry, 0) + 0.5
        return math.log(a / (n_toxic + 1)) - math.log(b / (n_clean + 1)) - 2 * math.sqrt(1 / a + 1 / b)

    weights = {e: w for e in by if (w := weight(e)) >= LEAST_WEIGHT}
    if not (n_toxic and n_clean):
        return Lexicon(words={_one(w): s for w, s in SEED.items()})
    lexicon = Lexicon(
        words={e: w for (e, is_stem), w in weights.items() if not is_stem},
        stems={e: w for (e, is_stem), w in weights.items() if is_stem},
    )
    lexicon = Lexicon(lexicon.words, lexicon.stems, _exceptions(train, lexicon))
    # At most ``most`` rows.
    rows = _measure(train.select(F.col("_label").cast("int"), "text"), lexicon, ["_label"], "_label int").select("_label", "total", "top", "words").collect()
    x = np.array([_features(r["total"], r["top"], r["words"]) for r in rows])
    return Lexicon(lexicon.words, lexicon.stems, lexicon.exceptions, fit(x, np.array([r["_label"] for r in rows], float)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps, slightly shrunk so that separable data end as well."""
    weights = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], penalty)
    keep[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(w) for w in weights)


def held_out() -> Column:
    return (F.crc32(F.col("doc_id").cast("string")) % 5) == 0


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, predicted, and what the score rests on: weights found, hits, words."""
    measured = _measure(docs.select(F.col("doc_id").cast("bigint"), "text"), lexicon, ["doc_id"], "doc_id bigint")
    return measured.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accept(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The documents that are not toxic, with all their columns, in one pass without a shuffle."""
    schema = docs.schema
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton() if lexicon.words or lexicon.stems else None
        model = np.array(lexicon.model)
        for batch in batches:
            stay = []
            for text in batch.column(place):
                words = folded_words(text.as_py() or "")
                total, top, _ = _matches(automaton, words) if automaton and words else (0.0, 0.0, 0)
                stay.append(bool(np.dot(model, _features(total, top, len(words))) < 0))
            yield batch.filter(pa.array(stay, pa.bool_()))

    return in_batches(docs, work, schema)
