"""A quality classifier from positive and unlabelled texts: the non-negative unbiased risk, minimised exactly.

Trusted positives are documents labelled 1, the documents of the training folds are the unlabelled web
text, and labels 0 are never read. For a linear score g, the logistic loss l and the class prior p,
the risk is ``p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)])``: what unlabelled texts lose as negatives,
less the positives among them, which can't be below zero. It is the larger of two convex functions,
the unbiased risk A and ``B = p E+[l(g)]``, so its minimum is that of some mixture of both: of A
alone where A stays above B there, else of the mixture at whose minimum they are equal, which a
secant search on the weight finds. Each mixture is minimised by Newton's method. Every step is one
pass over the feature rows of the whole corpus: each partition adds up its losses, gradients and
second derivatives in NumPy, a ``groupBy`` merges them, and the driver holds one matrix of the
features' squared number.

The prior is estimated on the way: a plain positive-against-unlabelled model ranks all rows; for each
cutoff, the share of unlabelled rows above it divided by that of positives bounds the prior, and the
cutoff whose upper bound (Hoeffding, for both shares) is smallest gives the estimate (best bin).

Features come from whole texts: how often one class of bytes follows another, sizes and shares of
words, repeated words and lines, and how well the text compresses. No feature looks at lang, source,
doc_id or labels. Means and deviations are taken over all documents. Feature rows (about 370 bytes) are
written once and deleted when the scores are written; texts are never shuffled.

Defined results: a null text is an empty one, which has features and a score; labels that are null,
repeated or of no document count once or not at all (a document is positive if any of its label rows
says 1); a null doc_id has no label and is not held out; rows that repeat are scored each, and count
each. Without any trusted positive the score is 0.5 for all; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import Steps

FOLDS = 4
HELD_OUT = 2
CUTOFF = 0.7
#: Ridge on standardised features, and the gain at which Newton's method ends (at most so many passes).
RIDGE = 2e-3
SETTLED = 1e-6
MOST_PASSES = 25
#: Mixtures tried at most, and the difference of the two risks that counts as none.
MIXTURES = 8
EQUAL = 1e-3
#: Cutoffs of the prior's estimate, the probability that its bounds fail, and the largest prior.
BINS = 1000
DELTA = 0.1
MOST_PRIOR = 0.999
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Classes of bytes: blank, line end, lower, upper, beyond ASCII, digit, sentence mark, symbol, other.
_CLASSES = (b" \t\x0b\x0c", b"\n\r", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", bytes(range(128, 256)), b"0123456789", b".,;:!?'\"()-", b"#*$%&|<>")
N_CLASSES = len(_CLASSES) + 1
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _c, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members)] = _c
WORD_FEATURES = ("log_words", "mean_length", "short_share", "long_share", "distinct", "adjacent_equal", "repeated_lines", "short_lines", "mark_ends", "capital_starts", "compressed")
N_FEATURES = N_CLASSES * N_CLASSES + len(WORD_FEATURES)
#: Standardised features are held within these bounds, so that one odd text can't outweigh all others.
FARTHEST = 8.0


def features(text: str) -> np.ndarray:
    """The features of one whole text."""
    out = np.zeros(N_FEATURES)
    raw = text.encode("utf-8", "replace")
    classes = _CLASS_OF[np.frombuffer(raw, np.uint8)]
    if len(classes) > 1:
        pairs = np.bincount(classes[:-1].astype(np.int64) * N_CLASSES + classes[1:], minlength=N_CLASSES * N_CLASSES)
        out[: N_CLASSES * N_CLASSES] = np.sqrt(pairs / (len(classes) - 1))
    words = WORD.findall(text)
    if words:
        n, lines = len(words), [x for x in text.split("\n") if x]
        lengths = np.fromiter(map(len, words), np.int64, n)
        out[N_CLASSES * N_CLASSES :] = (
            math.log(n), math.log(lengths.mean()), (lengths <= 3).mean(), (lengths > 12).mean(), math.log(len(set(words)) + 1) / math.log(n + 1),
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, 1 - len(set(lines)) / max(1, len(lines)), sum(len(x) < 30 for x in lines) / max(1, len(lines)),
            sum(not w[-1].isalnum() for w in words) / n, sum(w[0].isupper() for w in words) / n, len(zlib.compress(raw, 1)) / (len(raw) + 20),
        )
    return out


def fold(doc_id: Column) -> Column:
    """CRC-32 of the decimal id, modulo the number of folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


FEATURES = "doc_id long, vector binary"


def feature_rows(documents: DataFrame) -> DataFrame:
    """doc_id and the text's features as little-endian 32-bit floats."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = [features(t if isinstance(t, str) else "").astype("<f4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "vector": vectors})

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, FEATURES)


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, vector, held_out, and positive: labelled 1 and not held out."""
    positive = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("one")).where("doc_id IS NOT NULL").distinct()
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    rows = feature_rows(documents).join(positive, "doc_id", "left").withColumn("held_out", held_out)
    return rows.select("doc_id", "vector", "held_out", (F.col("one").isNotNull() & ~held_out).alias("positive"))


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(batch["vector"]), "<f4").reshape(-1, N_FEATURES).astype(float)


def _total(rows: DataFrame, add, size: int) -> np.ndarray:
    """The sum over all batches of add(batch), an array of so many numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += add(batch)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"item": at.astype("int32"), "value": total[at]})

    merged = np.zeros(size)
    for r in rows.mapInPandas(run, "item int, value double").groupBy("item").agg(F.sum("value").alias("value")).collect():
        merged[r["item"]] = r["value"]
    return merged


@dataclass(frozen=True)
class Scale:
    mean: np.ndarray
    deviation: np.ndarray

    def __call__(self, batch: pd.DataFrame) -> np.ndarray:
        """Standardised features and a last column of ones."""
        x = np.clip((_matrix(batch) - self.mean) / self.deviation, -FARTHEST, FARTHEST)
        return np.hstack([x, np.ones((len(x), 1))])


def scale_of(rows: DataFrame) -> Scale:
    def add(batch: pd.DataFrame) -> np.ndarray:
        x = _matrix(batch)
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    n, both = (t := _total(rows.select("vector"), add, 1 + 2 * N_FEATURES))[0], t[1:].reshape(2, -1)
    mean, square = both / max(n, 1)
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return Scale(mean, np.where(deviation > 1e-6, deviation, 1.0))


def sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -500, 500)))


@dataclass
class Sums:
    """Losses with their first and second derivatives at some weights, as means over positives and over unlabelled rows.

    pos: l(g) over positives; neg: l(-g) over positives; unl: l(-g) over unlabelled rows.
    """

    positives: float
    unlabelled: float
    pos: float
    neg: float
    unl: float
    d_pos: np.ndarray
    d_neg: np.ndarray
    d_unl: np.ndarray
    h_pos: np.ndarray  # of l(g) and of l(-g) alike
    h_unl: np.ndarray


_WIDTH = N_FEATURES + 1
_UPPER = np.triu_indices(_WIDTH)


def sums_at(training: DataFrame, scale: Scale, w: np.ndarray) -> Sums:
    def add(batch: pd.DataFrame) -> np.ndarray:
        x, positive = scale(batch), batch["positive"].to_numpy(bool)
        g = x @ w
        s = sigmoid(g)
        curved = x * (s * (1 - s))[:, None]
        p = x[positive]
        return np.concatenate([
            [len(p), len(x), np.logaddexp(0, -g[positive]).sum(), np.logaddexp(0, g[positive]).sum(), np.logaddexp(0, g).sum()],
            p.T @ (s[positive] - 1), p.T @ s[positive], x.T @ s, (curved[positive].T @ p)[_UPPER], (curved.T @ x)[_UPPER],
        ])

    n = len(_UPPER[0])
    t = _total(training, add, 5 + 3 * _WIDTH + 2 * n)
    parts = np.split(t, np.cumsum([5, _WIDTH, _WIDTH, _WIDTH, n]))
    p, u = max(t[0], 1), max(t[1], 1)

    def square(upper: np.ndarray) -> np.ndarray:
        out = np.zeros((_WIDTH, _WIDTH))
        out[_UPPER] = upper
        return out + np.triu(out, 1).T

    return Sums(t[0], t[1], t[2] / p, t[3] / p, t[4] / u, parts[1] / p, parts[2] / p, parts[3] / u, square(parts[4]) / p, square(parts[5]) / u)


def newton(at, objective, w: np.ndarray) -> tuple[np.ndarray, Sums]:
    """Weights that minimise a convex objective (value, gradient, Hessian of Sums) plus the ridge; at(w) gives the sums."""
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 0
    value = lambda s, w: objective(s)[0] + (ridge * w * w).sum() / 2
    s, passes = at(w), 1
    while passes < MOST_PASSES:
        _, gradient, hessian = objective(s)
        gradient = gradient + ridge * w
        step = np.linalg.solve(hessian + np.diag(ridge + 1e-9), gradient)
        gain = float(gradient @ step) / 2
        if gain < SETTLED:
            break
        share, now = 1.0, value(s, w)
        while True:
            new = at(w - share * step)
            passes += 1
            if value(new, w - share * step) <= now - 1e-4 * share * gain or passes >= MOST_PASSES:
                break
            share /= 4
        if value(new, w - share * step) > now:
            break
        w, s = w - share * step, new
    return w, s


def ranking(s: Sums) -> tuple[float, np.ndarray, np.ndarray]:
    """Positives against unlabelled rows, both sides weighing the same."""
    return (s.pos + s.unl) / 2, (s.d_pos + s.d_unl) / 2, (s.h_pos + s.h_unl) / 2


def mixture(prior: float, weight: float):
    """weight times the unbiased risk and the rest times the positives' own; l(g) - l(-g) is -g, so the former is convex."""

    def objective(s: Sums) -> tuple[float, np.ndarray, np.ndarray]:
        unbiased = prior * (s.pos - s.neg) + s.unl, prior * (s.d_pos - s.d_neg) + s.d_unl, s.h_unl
        own = prior * s.pos, prior * s.d_pos, prior * s.h_pos
        return tuple(weight * a + (1 - weight) * b for a, b in zip(unbiased, own, strict=True))

    return objective


def class_prior(training: DataFrame, scale: Scale, w: np.ndarray) -> float:
    """The best bin's estimate of the share of positives among unlabelled rows, from the scores of all rows."""

    def add(batch: pd.DataFrame) -> np.ndarray:
        s, positive = np.minimum((sigmoid(scale(batch) @ w) * BINS).astype(int), BINS - 1), batch["positive"].to_numpy(bool)
        return np.concatenate([np.bincount(s[positive], minlength=BINS), np.bincount(s, minlength=BINS)]).astype(float)

    counts = _total(training, add, 2 * BINS).reshape(2, BINS)
    (p, u), above = counts.sum(axis=1), counts[:, ::-1].cumsum(axis=1)[:, ::-1]
    slack = math.sqrt(math.log(4 / DELTA) / 2 / p) + math.sqrt(math.log(4 / DELTA) / 2 / u)
    seen = above[0] > 0
    ratio = (above[1][seen] / u) / (above[0][seen] / p)
    return float(min(MOST_PRIOR, ratio[np.argmin(ratio + slack / (above[0][seen] / p))]))


@dataclass(frozen=True)
class Model:
    """Scores are probabilities of label 1. risk: the non-negative risk; weight: of the unbiased risk in the mixture; passes: over all rows."""

    scale: Scale
    weights: np.ndarray
    prior: float
    risk: float
    weight: float
    passes: int


def fit(rows: DataFrame) -> Model | None:
    """The model for rows of training_rows(); None where there is no trusted positive."""
    training = rows.where(~F.col("held_out")).select("vector", "positive")
    if training.where("positive").isEmpty():
        return None
    scale, passes = scale_of(rows), 2

    def at(w: np.ndarray) -> Sums:
        nonlocal passes
        passes += 1
        return sums_at(training, scale, w)

    w, _ = newton(at, ranking, np.zeros(_WIDTH))
    prior = class_prior(training, scale, w)
    negative = lambda s: s.unl - prior * s.neg  # noqa: E731  the risk that must not be below zero
    w, s = newton(at, mixture(prior, 1.0), w)
    weight = 1.0
    if negative(s) < 0:
        low, high, seen = 0.0, 1.0, [(1.0, negative(s))]
        for _ in range(MIXTURES):
            weight = (low + high) / 2
            if len(seen) > 1:  # the secant through the last two, kept inside the bracket
                (a, fa), (b, fb) = seen[-2:]
                if fa != fb:
                    weight = min(max(b - fb * (b - a) / (fb - fa), low + (high - low) / 10), high - (high - low) / 10)
            w, s = newton(at, mixture(prior, weight), w)
            seen.append((weight, negative(s)))
            if abs(negative(s)) <= EQUAL:
                break
            low, high = (low, weight) if negative(s) < 0 else (weight, high)
    return Model(scale, w, prior, prior * s.pos + max(0.0, negative(s)), weight, passes)


def score_rows(rows: DataFrame, model: Model | None, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                score = sigmoid(model.scale(batch) @ model.weights) if model else np.full(len(batch), 0.5)
                yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": score, "predicted": (score >= cutoff).astype("int32")})

    return rows.select("doc_id", "vector", "held_out").mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(documents: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 from the cutoff on) of every document."""
    steps = Steps(documents.sparkSession)
    rows = steps.save(training_rows(documents, labels), "features")
    scored = steps.save(score_rows(rows, fit(rows), cutoff), "scores")
    steps.drop(rows)
    return scored
