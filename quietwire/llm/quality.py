"""Quality of documents by positive-unlabelled learning.

Trusted positives and unlabelled text are all it learns from; no negative label is read. A classifier
on the shape of texts (lengths, case, signs, repetition, lines) minimises the non-negative unbiased
risk

    prior * risk(positives as 1) + max(0, risk(unlabelled as 0) - prior * risk(positives as 0)),

the bracket being what the unlabelled negatives cost. Whenever a step takes the bracket below zero,
the step is reversed, which is what keeps it from fitting the positives in the unlabelled text. The
share of positives in unlabelled text (the prior) is estimated first: where positives are dense and a
first classifier surest, unlabelled text is all positive, so the ratio of the two densities there is it.
The densities are counted over all positives and all unlabelled rows, in bins of the score.

At most POSITIVES and UNLABELLED texts are fitted on, drawn by a hash of their id, one row of each id.
Scores and the prior cover all documents and whole texts. Null and empty texts have the shape of an empty text and get its score.
Repeated rows get the same score. Without positives every score is the default prior. Other columns
of ``docs`` are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import in_batches
from quietwire.session import stage

POSITIVES = 6_000
UNLABELLED = 12_000
DEFAULT_PRIOR = 0.8
# Taken off the estimated prior, which is an upper bound. A prior too low shifts scores a little; one
# too high turns the bracket off before the negatives are found.
MARGIN = 0.03
# Cuts of each feature for its step functions, as shares of the sample.
CUTS = (0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98)

# Scores of the first classifiers are counted in bins this wide, up to BINS on both sides of 0.
BIN, BINS = 1 / 128, 4096

FEATURES = (
    "words", "length", "word_length", "spread", "longest", "upper", "capitals", "digits", "signs", "odd_ends", "bare_signs",
    "variety", "commonest", "stutter", "short", "sentences", "lines", "line_length", "same_lines", "entropy", "foreign", "links",
)

_PROSE_END = frozenset(".,;:?\"')]}»”’-")


def shape(text: str) -> list[float]:
    """The features of one text, each a share, a mean or a logarithm, in the order of FEATURES."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words = text.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(raw, minlength=256)
    lengths = np.fromiter(map(len, words), np.int64, n)
    upper = counts[65:91].sum()
    letters = upper + counts[97:123].sum() + counts[192:].sum()
    ends = Counter([w[-1] for w in words])
    odd = sum(c for e, c in ends.items() if not e.isalnum() and e not in _PROSE_END)
    signs = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x]
    p = counts[counts > 0] / size
    return [
        np.log1p(n),
        np.log1p(size),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        upper / max(letters, 1),
        sum(map(str.isupper, words)) / n,
        counts[48:58].sum() / size,
        signs / size,
        odd / n,
        sum(c for w, c in seen.items() if not any(map(str.isalnum, w))) / n,
        len(seen) / n,
        max(seen.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        float((lengths <= 3).mean()),
        (ends["."] + ends["?"] + ends["!"]) / n,
        np.log1p(len(lines)),
        np.log1p(n / max(len(lines), 1)),
        1 - len(set(lines)) / max(len(lines), 1),
        float(-(p * np.log2(p)).sum()),
        counts[128:].sum() / size,
        (text.count("http") + text.count("@")) / n,
    ]


@dataclass(frozen=True)
class Model:
    """Cuts of every feature, and weights of the steps at those cuts."""

    cuts: np.ndarray | None = None
    weights: np.ndarray | None = None
    prior: float = DEFAULT_PRIOR

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(_steps(x, self.cuts) @ self.weights, -30, 30)))


def _steps(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A constant and, per feature and cut, whether the value lies above it."""
    above = (x[:, :, None] > cuts[None, :, :]).reshape(len(x), -1)
    return np.concatenate([np.ones((len(x), 1)), above.astype(float)], axis=1)


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _slope(z: np.ndarray) -> np.ndarray:
    return -1 / (1 + np.exp(np.clip(z, -30, 30)))


def _descend(gradient, weights: np.ndarray, rounds: int, rate: float) -> np.ndarray:
    """Adam: steps scaled by running means of the gradient and its square."""
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        g = gradient(weights)
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        weights = weights - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return weights


def estimate_prior(p: np.ndarray, u: np.ndarray, least: float = 0.4, of_p: np.ndarray | None = None, of_u: np.ndarray | None = None) -> float:
    """Share of positives in ``u`` from scores: the least ratio of unlabelled to positive mass above a threshold.

    ``of_p`` and ``of_u`` tell how many rows have each score, if not one. Only thresholds with at
    least ``least`` of the positives above them count, as others are noise.
    """
    of_p, of_u = (np.ones(len(x)) if n is None else np.asarray(n, float) for x, n in ((p, of_p), (u, of_u)))
    by = np.argsort(p)
    mass = np.cumsum(of_p[by])
    shares = np.linspace(0, 1 - least, 60)
    levels = p[by][np.minimum(np.searchsorted(mass, shares * mass[-1]), len(p) - 1)]
    above_p = np.array([of_p[p >= t].sum() for t in levels]) / of_p.sum()
    above_u = np.array([of_u[u >= t].sum() for t in levels]) / of_u.sum()
    return float(np.clip((above_u / np.maximum(above_p, 1e-9)).min(), 0.05, 0.98))


Sample = tuple[np.ndarray, np.ndarray]
Judges = list[np.ndarray]


def train(
    positive: Sample, unlabelled: Sample, prior_of: Callable[[np.ndarray, Judges], float], rounds: int = 400, rate: float = 0.03, penalty: float = 1e-4
) -> Model:
    """From the features and halves (0 or 1) of sampled rows; ``prior_of`` counts with cuts and the classifier for each half."""
    if min(len(positive[0]), len(unlabelled[0])) < 2:
        return Model()
    cuts = np.quantile(np.concatenate([positive[0], unlabelled[0]]), CUTS, axis=0).T
    p, u = _steps(positive[0], cuts), _steps(unlabelled[0], cuts)
    start = np.zeros(p.shape[1])

    # Each half is judged by a classifier of the other half: on its own rows it would be too sure.
    judges = []
    for half in (0, 1):
        a, b = (x[halves != half] if (halves != half).any() else x for x, halves in ((p, positive[1]), (u, unlabelled[1])))

        def apart(w: np.ndarray, a: np.ndarray = a, b: np.ndarray = b) -> np.ndarray:
            return a.T @ _slope(a @ w) / len(a) - b.T @ _slope(-(b @ w)) / len(b) + 10 * penalty * w

        judges.append(_descend(apart, start, rounds // 2, rate))
    prior = max(prior_of(cuts, judges) - MARGIN, 0.05)

    def risk(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        as_negative = _loss(-zu).mean() - prior * _loss(-zp).mean()
        towards_negative = -u.T @ _slope(-zu) / len(u) + prior * p.T @ _slope(-zp) / len(p)
        if as_negative < 0:
            return -towards_negative
        return prior * p.T @ _slope(zp) / len(p) + towards_negative + penalty * w

    return Model(cuts, _descend(risk, start, rounds, rate), prior)


def _shapes(texts: DataFrame) -> DataFrame:
    """doc_id and the features of every text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([shape(t.as_py() or "") for t in batch.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["doc_id", "shape"])

    return in_batches(texts.select(F.col("doc_id").cast("bigint"), "text"), work, "doc_id bigint, shape array<double>")


def _half(doc_id: Column) -> Column:
    return F.xxhash64(doc_id, F.lit(1)).bitwiseAND(F.lit(1)).cast("int")


def _sample(docs: DataFrame, ids: DataFrame, most: int) -> Sample:
    """Features and halves of at most ``most`` documents, drawn by a hash of their id; of rows with one id, one."""
    ids = ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).where(F.col("doc_id").isNotNull())
    drawn = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.withColumn("doc_id", F.col("doc_id").cast("bigint")).join(F.broadcast(stage(drawn, "drawn-ids")), "doc_id")
    rows = _shapes(texts).groupBy("doc_id").agg(F.min("shape").alias("shape")).withColumn("half", _half(F.col("doc_id"))).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return np.array([r["shape"] for r in rows], float).reshape(len(rows), len(FEATURES)), np.array([r["half"] for r in rows], int)


def _prior(docs: DataFrame, positives: DataFrame, unlabelled: DataFrame, cuts: np.ndarray, judges: Judges) -> float:
    """The share of positives among all rows that ``unlabelled`` names, from counts of rows by bin of the score."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.stack(judges, axis=1)
        for batch in batches:
            x = np.array([shape(t.as_py() or "") for t in batch.column(2)], float).reshape(batch.num_rows, len(FEATURES))
            half = batch.column(1).to_numpy(zero_copy_only=False)
            z = (_steps(x, cuts) @ weights)[np.arange(batch.num_rows), half]
            bins = np.clip(np.floor(z / BIN), -BINS, BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bins)], ["doc_id", "half", "bin"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("doc_id").isNotNull())
    judged = in_batches(texts.select("doc_id", _half(F.col("doc_id")).alias("half"), "text"), work, "doc_id bigint, half int, bin int")
    # Repeated rows are counted before they meet the names.
    judged = stage(judged.groupBy("doc_id", "half", "bin").agg(F.count(F.lit(1)).alias("n")), "judged")
    counts = []
    for names in (positives, unlabelled):
        names = names.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
        counted = judged.join(names, "doc_id", "left_semi").groupBy("half", "bin").agg(F.sum("n").alias("n"))
        counts.append(np.array([tuple(r) for r in counted.collect()], float).reshape(-1, 3))  # two rows a bin at most
    ratios = []
    for half in (0, 1):
        p, u = (c[c[:, 0] == half] for c in counts)
        if len(p) and len(u):
            ratios.append(estimate_prior(p[:, 1], u[:, 1], of_p=p[:, 2], of_u=u[:, 2]))
    return sum(ratios) / len(ratios) if ratios else DEFAULT_PRIOR


def learn(docs: DataFrame, positives: DataFrame, unlabelled: DataFrame, most: tuple[int, int] = (POSITIVES, UNLABELLED)) -> Model:
    """``positives`` and ``unlabelled`` name documents by doc_id."""
    samples = _sample(docs, positives, most[0]), _sample(docs, unlabelled, most[1])
    return train(*samples, lambda cuts, judges: _prior(docs, positives, unlabelled, cuts, judges))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([shape(t.as_py() or "") for t in batch.column(1)], float).reshape(batch.num_rows, len(FEATURES))
            scores = model.scores(x)
            found = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), found], ["doc_id", "score", "predicted"])

    return in_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), work, "doc_id bigint, score double, predicted int")
