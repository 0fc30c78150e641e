"""The positive-unlabelled classifier: sums against finite differences, the minimum against other weights, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pytest

from concordat.llm import classifier

RNG = random.Random(6)
DOCS = "doc_id long, text string, lang string, source string, score string, vector int"
LABELS = "doc_id long, quality int, toxic int"
WORDS = ["".join(RNG.choices("abcdefghé", k=RNG.randint(1, 8))) for _ in range(400)]


def good():
    return " ".join(w + ("." if RNG.random() < 0.1 else "") for w in RNG.choices(WORDS, k=RNG.randint(20, 150)))


def bad():
    kind, words = RNG.randint(0, 3), RNG.choices(WORDS, k=RNG.randint(20, 150))
    if kind == 0:
        return " | ".join(words)
    if kind == 1:
        return " ".join(words[:2] * 40)
    if kind == 2:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join(w + RNG.choice(["###", "$$$", "&&&"]) for w in words)


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def truth():
    return {i: int(RNG.random() < 0.8) for i in range(1600)}


@pytest.fixture(scope="module")
def docs(spark, truth):
    return spark.createDataFrame([(i, good() if q else bad(), "en", "s", "x", 1) for i, q in truth.items()], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark, truth):
    return spark.createDataFrame([(i, q, 0) for i, q in truth.items() if i % 2], LABELS)


@pytest.fixture(scope="module")
def rows(docs, labels):
    return classifier.training_rows(docs, labels).cache()


@pytest.fixture(scope="module")
def model(rows):
    return classifier.fit(rows)


@pytest.fixture(scope="module")
def dense(rows, model):
    """Standardised features of positives and of all training rows, as the driver may hold in a test."""
    frame = rows.where("NOT held_out").toPandas()
    x = model.scale(frame)
    return x[frame["positive"].to_numpy(bool)], x


def risk(w, prior, p, u):
    """The non-negative risk from its definition, with the ridge."""
    loss = lambda z: np.logaddexp(0, -z)
    return prior * loss(p @ w).mean() + max(0.0, loss(-(u @ w)).mean() - prior * loss(-(p @ w)).mean()) + classifier.RIDGE * (w[:-1] ** 2).sum() / 2


def test_training_rows(rows, truth):
    got = {r.doc_id: (r.held_out, r.positive) for r in rows.collect()}
    assert got == {i: (held(i), bool(q and i % 2 and not held(i))) for i, q in truth.items()}


def test_sums_equal_their_definition(rows, model, dense):
    p, u = dense
    training = rows.where("NOT held_out").select("vector", "positive")
    w = np.random.default_rng(1).standard_normal(len(model.weights)) * 0.1
    s = classifier.sums_at(training, model.scale, w)
    one = lambda w: classifier.sums_at(training, model.scale, w)
    assert (s.positives, s.unlabelled) == (len(p), len(u))
    assert np.allclose([s.pos, s.neg, s.unl], [np.logaddexp(0, -(p @ w)).mean(), np.logaddexp(0, p @ w).mean(), np.logaddexp(0, u @ w).mean()])
    d = np.random.default_rng(2).standard_normal(len(w)) * 1e-4
    ahead, behind = one(w + d), one(w - d)
    for value, slope, curve in (("pos", "d_pos", "h_pos"), ("neg", "d_neg", "h_pos"), ("unl", "d_unl", "h_unl")):
        assert np.isclose(getattr(ahead, value) - getattr(behind, value), 2 * getattr(s, slope) @ d, rtol=1e-4, atol=1e-12)
        assert np.allclose(getattr(ahead, slope) - getattr(behind, slope), 2 * getattr(s, curve) @ d, rtol=1e-3, atol=1e-8)


def test_no_other_weights_have_a_smaller_risk(model, dense):
    p, u = dense
    least = risk(model.weights, model.prior, p, u)
    rng = np.random.default_rng(3)
    for size in (1e-3, 1e-2, 0.1, 1.0):
        for _ in range(200):
            assert risk(model.weights + size * rng.standard_normal(len(model.weights)) / 10, model.prior, p, u) > least - 2 * classifier.EQUAL
    w, step = model.weights.copy(), 1e-2
    for _ in range(3000):  # plain descent on the risk itself finds nothing better either
        own = p.T @ (classifier.sigmoid(p @ w) - 1) / len(p)
        rest = u.T @ classifier.sigmoid(u @ w) / len(u) - model.prior * p.T @ classifier.sigmoid(p @ w) / len(p)
        above = np.logaddexp(0, u @ w).mean() > model.prior * np.logaddexp(0, p @ w).mean()
        slope = model.prior * own + (rest if above else 0)
        slope[:-1] += classifier.RIDGE * w[:-1]
        w, step = w - step * slope, step * 0.999
    assert risk(w, model.prior, p, u) > least - 2 * classifier.EQUAL


def test_prior_and_held_out_accuracy(docs, labels, truth, model):
    assert abs(model.prior - 0.8) < 0.12
    assert 0 <= model.risk < 0.2
    got = {r.doc_id: r for r in classifier.classify(docs, labels).collect()}
    assert set(got) == set(truth) and all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    own = [i for i in truth if held(i)]
    assert sum(got[i].predicted == truth[i] for i in own) / len(own) > 0.97


def test_labels_that_must_not_be_read_change_nothing(spark, docs, labels, truth):
    want = {r.doc_id: r.score for r in classifier.classify(docs, labels).collect()}
    odd = [(i, q if not held(i) else 1 - q, 1) for i, q in truth.items() if i % 2 and (q or held(i))]
    odd += [(i, 1, 0) for i in truth if held(i)] + [(None, 1, 0), (99_999, 1, 0), (5, None, None)] + [(i, 1, 0) for i, q in truth.items() if i % 2 and q and not held(i)]
    got = {r.doc_id: r.score for r in classifier.classify(docs.withColumn("lang", docs.text), spark.createDataFrame(odd, LABELS)).collect()}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_edge_cases(spark, labels):
    texts = [None, "", " \n\t", "a", "é" * 100_000, "w " * 200_000, "\x00� 😀", good(), good()]
    made = [(i, t, None, None, None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*made, made[8], (None, good(), "x", "y", "z", 1)], DOCS)
    for known in (labels, labels.limit(0)):
        got = classifier.classify(df, known).collect()
        assert len(got) == 11 and sorted(r.held_out for r in got) == sorted(bool(r.doc_id is not None and held(r.doc_id)) for r in got)
        assert all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got} == {0.5}
    assert classifier.classify(df.limit(0), labels).count() == 0
    assert not classifier.features("").any() and np.isfinite([classifier.features(t or "") for t in texts]).all()
