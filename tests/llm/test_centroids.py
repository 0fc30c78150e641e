"""Lloyd's algorithm in whole numbers against brute force on Python's integers."""

import collections
import hashlib
import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from concordat.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string"
TOP = (1 << 63) - 1


def by_hand(rows, k, rounds, salt, dim):
    """(vec_id, cluster, distance, cluster_inertia, inertia, digest) of every kept row, from exact fractions."""
    kept = [(i, tuple(math.floor(Fraction(x) * 1024) for x in v)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min(range(len(centres)), key=lambda c: (far(v, centres[c]), c))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)].append(v)
        centres = [tuple(sum(x) // len(groups[c]) for x in zip(*groups[c], strict=True)) if groups[c] else old for c, old in enumerate(centres)]
    at = [nearest(v) for _, v in kept]
    own = collections.Counter()
    for (_, v), c in zip(kept, at, strict=True):
        own[c] += far(v, centres[c])
    held = lambda n: n if n <= TOP else None
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return collections.Counter((i, c, held(far(v, centres[c])), held(own[c]), held(sum(own.values())), name[c]) for (i, v), c in zip(kept, at, strict=True))


def got(df, **how):
    found = centroids.clustered(df, **how)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return collections.Counter(tuple(r) for r in found.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    made = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 64)) * 0.2)]
    made[60:140] = [(i, made[60][1]) for i in range(60, 140)]  # a group of copies
    edge = [(500, None), (501, []), (502, [1.0] * 63), (503, [0.5] * 63 + [None]), (504, [float("nan")] * 64), (505, [float("inf")] + [0.0] * 63), (506, [-0.0] * 64), (None, [0.25] * 64), (507, [-1 / 2048] * 64)]
    return made + edge + [made[5], made[5]]


def test_equals_brute_force_in_any_partitioning(spark, rows):
    want = by_hand(rows, 8, 10, 3, 64)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    for n in (1, 7):
        assert got(df.repartition(n)) == want
    as_float = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got(spark.createDataFrame(as_float, "vec_id long, embedding array<float>")) == by_hand(as_float, 8, 10, 3, 64)


def test_other_settings(spark, rows):
    small = [(i, v[:3]) for i, v in rows[:40]]
    for how in ({"k": 1, "rounds": 2}, {"k": 5, "rounds": 0}, {"k": 60, "rounds": 3, "salt": 9}):
        full = {"k": 8, "rounds": 10, "salt": 3, "dim": 3} | how
        assert got(spark.createDataFrame(small, "vec_id long, embedding array<double>"), **full) == by_hand(small, **full)
    with pytest.raises(ValueError):
        centroids.clustered(spark.createDataFrame(small, "vec_id long, embedding array<double>"), k=0)


def test_huge_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 64)) * 10.0 ** rng.integers(-3, 9, (60, 1)))]
    rows += [(100, [1.7e308] * 64), (101, [-1.7e308] + [3e200] * 63), (102, [131071.9] * 64), (103, [131072.0] * 64), (104, [-131072.0] * 64)]
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), k=12, rounds=4) == by_hand(rows, 12, 4, 3, 64)


def test_ties_and_empty_clusters(spark):
    rows = [(i, [float(x)]) for i, x in enumerate([0, 0, 0, 2, 2, 4, 1, 3])]
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=6, rounds=5, dim=1) == by_hand(rows, 6, 5, 3, 1)
    assert got(spark.createDataFrame([], "vec_id long, embedding array<double>")) == collections.Counter()
    assert got(spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")) == collections.Counter()


def test_limbs_add_up():
    for value in (0, 1, -1, 1 << 200, -(1 << 80) - 7, (1 << 40) - 1):
        assert sum(part << (centroids.LIMB * limb) for *_, limb, part in centroids._limbs(0, 0, value)) == value
    none = pd.concat(centroids.partial_sums(iter([]), [[1, 2]], 2))
    assert none.empty and list(none.columns) == ["cluster", "position", "limb", "part"]
