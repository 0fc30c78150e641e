"""Lloyd's k-means in whole numbers, so that results don't depend on partitions, order or retries.

A component x of a vector becomes floor(1024 * x). The centroids, k times the dimension whole numbers
(at most ``MOST_CENTROID_CELLS``), are broadcast each round; ``mapInPandas`` takes the squared
differences to each centroid in NumPy, argmin gives the lowest number among equally near centroids,
and what leaves a partition are its counts and sums, which a ``groupBy`` merges. The integer
vectors are written once, as little-endian 32-bit words, and read again each round, so a lost executor
repeats its own tasks only; they are deleted after the last round. Rounds that would not move a centroid any more are not run.

Defined results: vectors that are null, of another dimension, or hold null or non-finite components
have no row. Rows that repeat count each; a null ``vec_id`` is an empty text in the seed's hash.
Vectors with equal hashes are ordered by their components. With fewer vectors than k each is a centroid;
an empty table gives no rows. Components too large for 32-bit arithmetic (about 131,072 and more)
are carried as their original doubles and computed with Python's whole numbers; a distance or
inertia that no long can hold is null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.llm.common import Steps

SCALE = 1024
#: Packed components lie below it (see ``safe``).
MOST_SAFE = 1 << 27
MOST_CENTROID_CELLS = 1 << 20
#: Whole numbers leave a partition as longs; larger ones in pieces of so many bits.
LIMB = 40
LONGEST = (1 << 63) - 1
Whole = list[list[int]]

VECTORS = "vec_id long, packed binary, wide array<double>"
ASSIGNED = "vec_id long, cluster int, distance long"
PARTIAL = "cluster int, position int, limb int, part long"


def _whole(x: float) -> int:
    """floor(1024 * x) without overflow of the product."""
    return math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE


def safe(dim: int) -> int:
    """Squared distances between vectors whose components lie below it fit in 64 bits."""
    return min(MOST_SAFE, math.isqrt(LONGEST // dim) // 2)


def integer_vectors(vectors: DataFrame, dim: int = 64) -> DataFrame:
    """vec_id and the integer vector: packed, or, where a component is too large, wide (as given)."""
    x = F.col("embedding")
    good = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                given = np.stack(batch["x"].to_numpy())
                small = (np.abs(given) < safe(dim) // SCALE).all(axis=1)
                whole = np.floor(np.where(small[:, None], given, 0.0) * SCALE).astype("<i4")
                yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "packed": [w.tobytes() if s else None for w, s in zip(whole, small, strict=True)], "wide": [None if s else g for g, s in zip(given, small, strict=True)]})

    return vectors.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x")).mapInPandas(run, VECTORS)


def _batches(batches: Iterator[pd.DataFrame], dim: int) -> Iterator[tuple[pd.Series, np.ndarray]]:
    """Ids with int64 rows, and, apart, ids with rows of Python's whole numbers."""
    for batch in batches:
        small = batch["packed"].notna()
        if small.any():
            yield batch["vec_id"][small], np.frombuffer(b"".join(batch["packed"][small]), "<i4").reshape(-1, dim).astype(np.int64)
        if not small.all():
            yield batch["vec_id"][~small], np.array([[_whole(v) for v in row] for row in batch["wide"][~small]], dtype=object)


def nearest_centroid(rows: np.ndarray, centroids: Whole) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to each row's nearest centroid; the lowest number among equals."""
    columns = []
    for c in centroids:
        fits = rows.dtype != object and max(map(abs, c), default=0) <= safe(len(c))
        diff = rows - np.array(c, np.int64) if fits else rows.astype(object) - np.array(c, dtype=object)
        columns.append((diff * diff).sum(axis=1))
    table = np.stack(columns, axis=1)
    at = np.array([int(r.argmin()) for r in table]) if table.dtype == object else table.argmin(axis=1)
    return at, table[np.arange(len(table)), at]


def _limbs(cluster: int, position: int, value: int) -> Iterator[tuple[int, int, int, int]]:
    """The value as signed pieces: their sums, each times its power, are the sum of values."""
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield cluster, position, limb, sign * (value & ((1 << LIMB) - 1))
        value >>= LIMB
        limb += 1


def partial_sums(batches: Iterator[pd.DataFrame], centroids: Whole, dim: int) -> Iterator[pd.DataFrame]:
    """A partition's sums by centroid: positions 0 to dim - 1 its components, dim the count, dim + 1 the distances."""
    sums = np.zeros((len(centroids), dim + 2), dtype=object)
    for _, rows in _batches(batches, dim):
        at, distance = nearest_centroid(rows, centroids)
        for c in np.unique(at):
            own = rows[at == c]
            # A batch's int64 sums are exact: 2^27 times rows of a batch. Distances (to 2^62) are added as Python's numbers.
            sums[c, :dim] += np.array([int(s) for s in own.sum(axis=0)], dtype=object)
            sums[c, dim] += len(own)
            sums[c, dim + 1] += sum(distance[at == c].tolist())
    out = [piece for c, row in enumerate(sums) for p, value in enumerate(row) for piece in _limbs(c, p, int(value))]
    yield pd.DataFrame(out, columns=["cluster", "position", "limb", "part"]).astype({"cluster": "int32", "position": "int32", "limb": "int32", "part": "int64"})


def _merged(vectors: DataFrame, centroids: Whole, dim: int) -> list[list[int]]:
    """Sums over all vectors; what reaches the driver is bounded by centroids and dimension."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    try:
        parts = vectors.mapInPandas(lambda batches: partial_sums(batches, shared.value, dim), PARTIAL)
        total = parts.groupBy("cluster", "position", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    finally:
        shared.destroy()
    sums = [[0] * (dim + 2) for _ in centroids]
    for r in total:
        sums[r.cluster][r.position] += int(r.total) << (LIMB * r.limb)
    return sums


def seeds(vectors: DataFrame, k: int, salt: int, dim: int) -> Whole:
    """The k vectors with the smallest SHA-256 of '<salt>:<vec_id>', in that order."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select(digest.alias("digest"), "packed", "wide").orderBy("digest", "packed", "wide").limit(k).collect()
    return [[_whole(v) for v in r.wide] if r.packed is None else np.frombuffer(bytes(r.packed), "<i4").tolist() for r in first]


def lloyd(vectors: DataFrame, centroids: Whole, rounds: int, dim: int) -> tuple[Whole, list[int]]:
    """Centroids after the rounds, and the inertia of each cluster under them. Empty ones stay."""
    for _ in range(rounds):
        moved = [[s // row[dim] for s in row[:dim]] if row[dim] else c for c, row in zip(centroids, _merged(vectors, centroids, dim), strict=True)]
        if moved == centroids:
            break
        centroids = moved
    return centroids, [row[dim + 1] for row in _merged(vectors, centroids, dim)]


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, salt: int = 3, dim: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept row of (vec_id, embedding)."""
    if k < 1 or k * dim > MOST_CENTROID_CELLS:
        raise ValueError(f"k * dim must be 1 to {MOST_CENTROID_CELLS}")
    spark: SparkSession = vectors.sparkSession
    steps = Steps(spark)
    kept = steps.save(integer_vectors(vectors, dim), "vectors")
    start = seeds(kept, k, salt, dim)
    schema = T.StructType.fromDDL(ASSIGNED + ", cluster_inertia long, inertia long, centroid_sha256 string")
    if not start:
        steps.drop(kept)
        return spark.createDataFrame([], schema)
    centroids, inertias = lloyd(kept, start, rounds, dim)
    steps.drop(kept)
    held = lambda n: n if n <= LONGEST else None
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    own, whole = [held(n) for n in inertias], held(sum(inertias))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, rows in _batches(batches, dim):
            at, distance = nearest_centroid(rows, centroids)
            yield pd.DataFrame({
                "vec_id": ids.astype("Int64").to_numpy(), "cluster": at.astype("int32"),
                "distance": pd.array([held(int(d)) for d in distance], dtype="Int64"),
                "cluster_inertia": pd.array([own[c] for c in at], dtype="Int64"), "inertia": pd.array([whole] * len(at), dtype="Int64"),
                "centroid_sha256": [names[c] for c in at],
            })

    return integer_vectors(vectors, dim).mapInPandas(run, schema)
