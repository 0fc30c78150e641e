"""Approximate nearest neighbours by inner product: stable projections, kd-trees, chi-square stop.

Largest inner product is turned into least distance by one more coordinate, sqrt(M^2 - |x|^2) with M
the largest norm of all vectors (0 for queries, which are scaled to norm M, without effect on their
order). Vectors are projected by at most ``PROJECTED`` Gaussian (2-stable) directions, made orthogonal
to each other: the squared projected distance over the squared true distance then spreads less than
with independent directions, as a chi-square variable of ``freedom`` degrees does (scaled to its own
mean), which is what the stop test uses. Vectors with no more coordinates than directions are turned,
not reduced, and their search is exact.

All vectors are dealt to the cells of a top-level kd-tree over projections (its splits come from at
most ``SAMPLE`` projected vectors; every vector is indexed). A cell that holds more than
``CELL_ROWS`` vectors is dealt by hash into parts of about that size, each with a kd-tree of its own,
and one that more than ``CELL_QUERIES`` queries visit is copied, so that a task's vectors are bounded
and its queries shared. A query verifies its nearest leaf, which bounds its kth distance; leaves that
no query of its block can need are ruled out by their boxes, the others' vectors are taken in order
of projected distance (incremental neighbours) and verified in double precision until the stop: a
nearer vector with so large a projected distance would be an event of probability below ``MISS``,
chi2_cdf(projected^2 / kth distance^2) > 1 - MISS in the degrees and the scale above. First every query
searches its own cell; the distance found there bounds the projected distance at which other cells
can matter, and only those cells are searched, from that bound on. ``MISS`` is the chance for the farthest of the k neighbours where the bound is exact; nearer
ones, and all while bounds are still loose, are missed less often.

Equal vectors are one indexed vector with its ``k + 1`` smallest ids, and equal queries are searched
once, so a vector that a third of all rows share is no hot spot and results are the same.

Defined results: null, zero and non-finite vectors take no part, nor do rows without an id; vectors
of unequal lengths are refused. Fewer than k candidates give them all. Ties go to the smaller id.
Rows that share an id are ranked each; a query excludes all rows with its own id. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import Steps

PROJECTED = 32
SAMPLE = 20_000
CELL_ROWS = 8_000
CELL_QUERIES = 4_000
LEAF = 64
BLOCK = 256
FIRST = 256
MISS = 0.15
SEED = 20
K = 20


def chi2_cdf(x: float, m: int) -> float:
    """For even m: 1 - exp(-x/2) * sum_{i < m/2} (x/2)^i / i!."""
    if x <= 0:
        return 0.0
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi2_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, m) < p else (low, mid)
    return high


def directions(dim: int, m: int = PROJECTED, seed: int = SEED) -> np.ndarray:
    """Orthogonal Gaussian directions of the lifted space, at most as many as it has dimensions; a
    squared projected distance is on average as many times the true one as there are directions."""
    lifted = dim + 1
    free, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((lifted, min(m, lifted))))
    return free * math.sqrt(lifted)


def freedom(dim: int, m: int = PROJECTED) -> int:
    """Degrees (even, rounded down) of the scaled chi-square variable whose variance equals that of
    projected over true squared distance, a beta variable; 0 where nothing is reduced."""
    lifted = dim + 1
    return min(600, 2 * int(m * (lifted + 2) / (lifted - m) / 2)) if lifted > m else 0


def stop_factor(dim: int, miss: float, m: int = PROJECTED) -> float:
    """Squared projected distances beyond this many times the squared kth distance end a search."""
    degrees = freedom(dim, m)
    return m * chi2_quantile(1 - miss, degrees) / degrees if degrees else (dim + 1) * (1 + 1e-9)


def lift(x: np.ndarray, most: float, query: bool) -> np.ndarray:
    """One more coordinate, so that |q' - x'|^2 = 2 M^2 - 2 M <q, x> / |q|."""
    norm2 = np.einsum("ij,ij->i", x, x)
    if query:
        return np.hstack((x * (most / np.sqrt(norm2))[:, None], np.zeros((len(x), 1))))
    return np.hstack((x, np.sqrt(np.maximum(most * most - norm2, 0))[:, None]))


class KdTree:
    """Median splits along the widest axis; nodes as arrays, leaves as ranges of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.low, self.high, self.kids, self.range = [], [], [], []
        self._build(points, 0, len(points), leaf)

    def _build(self, points: np.ndarray, a: int, b: int, leaf: int) -> int:
        own = points[self.order[a:b]]
        node = len(self.kids)
        self.low.append(own.min(0))
        self.high.append(own.max(0))
        self.kids.append(None)
        self.range.append((a, b))
        spread = self.high[node] - self.low[node]
        if b - a > leaf and spread.max() > 0:
            mid = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, int(spread.argmax())], mid)]
            self.kids[node] = (self._build(points, a, a + mid, leaf), self._build(points, a + mid, b, leaf))
        return node

    def finish(self) -> None:
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.leaves = np.array([i for i, k in enumerate(self.kids) if k is None])

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distances of points to the leaves' boxes."""
        return box_distances(points, self.low[self.leaves], self.high[self.leaves])


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points (rows) to boxes (columns), an axis at a time."""
    far = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        p = points[:, axis, None]
        gap = np.maximum(np.maximum(low[:, axis] - p, p - high[:, axis]), 0)
        far += gap * gap
    return far


def search(tree: KdTree, vectors: np.ndarray, projected: np.ndarray, queries: np.ndarray, asked: np.ndarray, most: float, k: int, bounds: np.ndarray, stop: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each query of a block: rows (positions in ``order``) among which are the k best found of a
    cell, their inner products, their squared lifted distances, and how many vectors were verified.

    asked: the queries' projections; bounds: squared lifted distances within which k neighbours are
    known already; stop: see ``stop_factor``.
    """
    boxes = tree.distances(asked)
    scale = 2 * most * most
    slopes = 2 * most / np.sqrt(np.einsum("ij,ij->i", queries, queries))
    spans = np.array([tree.range[leaf] for leaf in tree.leaves])
    own = spans[boxes.argmin(1)]
    found, kths = [], bounds.copy()
    for i, (a, b) in enumerate(own):
        score = vectors[a:b] @ queries[i]
        far2 = scale - slopes[i] * score
        if b - a >= k:
            kths[i] = min(kths[i], max(0.0, np.partition(far2, k - 1)[k - 1]) * (1 + 1e-9) + 1e-12)
        found.append((score, far2))
    live = (boxes <= stop * kths[:, None]).any(0)
    at = np.concatenate([np.arange(a, b) for a, b in spans[live]]) if live.any() else np.empty(0, int)
    points = projected[at]
    gaps = np.einsum("ij,ij->i", points, points)[None, :] - 2 * (asked @ points.T) + np.einsum("ij,ij->i", asked, asked)[:, None]
    for i, ((a, b), (score, far2), q) in enumerate(zip(own, found, queries, strict=True)):
        near = np.flatnonzero(far2 <= kths[i])
        rows, scores, fars, verified = [near + a], [score[near]], [far2[near]], b - a
        best = np.sort(fars[0])[:k]
        passing = np.flatnonzero((gaps[i] <= stop * kths[i]) & ((at < a) | (at >= b)))
        passing = passing[np.argsort(gaps[i, passing], kind="stable")]
        start, step = 0, FIRST
        while start < len(passing) and gaps[i, passing[start]] <= stop * kths[i]:
            own_step = passing[start : start + step]
            rows_at = at[own_step[gaps[i, own_step] <= stop * kths[i]]]
            verified += len(rows_at)
            score = vectors[rows_at] @ q
            far2 = scale - slopes[i] * score
            near = np.flatnonzero(far2 <= kths[i])
            if len(near):
                rows.append(rows_at[near])
                scores.append(score[near])
                fars.append(far2[near])
                best = np.sort(np.concatenate((best, fars[-1])))[:k]
                if len(best) == k:
                    kths[i] = min(kths[i], max(0.0, best[-1]) * (1 + 1e-9) + 1e-12)
            start, step = start + step, step * 2
        yield np.concatenate(rows), np.concatenate(scores), np.concatenate(fars), verified


def _clean(batch: pd.DataFrame, column: str) -> tuple[np.ndarray, list[np.ndarray]]:
    ids, vectors = [], []
    for i, v in zip(batch["vec_id"], batch[column], strict=True):
        if v is None or pd.isna(i):
            continue
        x = np.array([math.nan if c is None else c for c in v] if isinstance(v, list) else v, dtype=np.float64)
        if len(x) and np.isfinite(x).all() and x.any():
            ids.append(int(i))
            vectors.append(x)
    return np.array(ids, np.int64), vectors


DISTINCT_SCHEMA = "key binary, ids array<long>, queries array<long>, norm double, dim int"


def _distinct(k: int, step: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            ids, vectors = _clean(batch, "vector")
            for i, x in zip(ids.tolist(), vectors, strict=True):
                held.setdefault((x + 0.0).tobytes(), []).append(i)
            rows = []
            for key, own in held.items():
                x = np.frombuffer(key)
                rows.append((key, sorted(own)[: k + 1], [i for i in own if i % step == 0], float(np.sqrt(x @ x)), len(x)))
            yield pd.DataFrame(rows, columns=["key", "ids", "queries", "norm", "dim"])

    return run


def distinct_vectors(embeddings: DataFrame, steps: Steps, column: str = "embedding", k: int = K, step: int = 20) -> tuple[DataFrame, DataFrame]:
    """(key, ids, norm, dim, searched) by distinct vector, and (key, query_id) for every query row.

    Equal vectors meet first in their task, then by key; ids keep the k + 1 smallest that any
    query can need.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("vector"))
    local = steps.save(rows.mapInPandas(_distinct(k, step), DISTINCT_SCHEMA), "vectors")
    smallest = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), F.lit(1), F.lit(k + 1))
    merged = local.groupBy("key").agg(smallest.alias("ids"), F.max("norm").alias("norm"), F.max("dim").alias("dim"), F.max(F.size("queries") > 0).alias("searched"))
    distinct = steps.save(merged, "distinct")
    queries = steps.save(local.select("key", F.explode("queries").alias("query_id")), "queries")
    steps.drop(local)
    return distinct, queries


def _cells(vectors: DataFrame, dim: int, most: float, cells: int) -> KdTree:
    """The top-level tree from a bounded sample of projected vectors."""
    share = min(1.0, SAMPLE / max(vectors.count(), 1))
    rows = vectors.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("key").limit(2 * SAMPLE).collect()
    points = lift(np.array([np.frombuffer(bytes(r.key)) for r in rows]), most, query=False) @ directions(dim)
    tree = KdTree(points, max(1, len(points) // cells))
    tree.finish()
    return tree


ROUTE_SCHEMA = "cell int, kind int, key binary, ids array<long>, bound double"
FOUND_SCHEMA = "key binary, hits array<struct<vec_id:long,score:double>>, kth double, verified long"


def nearest(embeddings: DataFrame, column: str = "embedding", k: int = K, step: int = 20, miss: float = MISS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id is divisible by step.

    The answer is a written table; what led to it is deleted.
    """
    steps = Steps(embeddings.sparkSession)
    distinct, queries = distinct_vectors(embeddings, steps, column, k, step)
    stats = distinct.agg(F.max("norm").alias("norm"), F.max("dim").alias("dim"), F.min("dim").alias("least"), F.count("*").alias("n")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not stats.n:
        steps.drop(distinct, queries)
        return embeddings.sparkSession.createDataFrame([], empty)
    if stats.dim != stats.least:
        raise ValueError(f"vectors of {stats.least} and of {stats.dim} numbers")
    dim, most = stats.dim, stats.norm
    tree = _cells(distinct, dim, most, max(1, stats.n // CELL_ROWS))
    stop = stop_factor(dim, miss)
    width, n_cells = directions(dim), len(tree.leaves)

    def project(keys: Iterable[bytes], query: bool) -> np.ndarray:
        return lift(np.array([np.frombuffer(x) for x in keys]), most, query) @ width

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every vector to the cell nearest to it, every searched one also to its cell as a query."""
        for batch in batches:
            if len(batch):
                stored = tree.distances(project(batch["key"], False)).argmin(1)
                yield pd.DataFrame({"cell": stored, "kind": 0, "key": batch["key"], "ids": batch["ids"], "bound": 0.0})
                asked = batch[batch["searched"]]
                if len(asked):
                    yield pd.DataFrame({"cell": tree.distances(project(asked["key"], True)).argmin(1), "kind": 1, "key": asked["key"], "ids": None, "bound": np.inf})

    routed = steps.save(distinct.select("key", "ids", "searched").mapInPandas(home, ROUTE_SCHEMA), "routes")
    steps.drop(distinct)
    stored, asked = routed.where("kind = 0"), routed.where("kind = 1")
    # The stored boxes, from all rows: cells are assigned to the nearest leaf, so boxes may grow.
    first = steps.save(_search_cells(stored.unionByName(asked), dim, most, k, stop), "found")
    boxes = _boxes(stored, project, n_cells)

    def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every query to the other cells that its bound leaves possible."""
        low, high = boxes
        for batch in batches:
            if not len(batch):
                continue
            kth = batch["kth"].to_numpy()
            possible = box_distances(project(batch["key"], True), low, high) <= stop * kth[:, None]
            possible[np.arange(len(batch)), batch["cell"]] = False
            rows, cells = np.nonzero(possible)
            yield pd.DataFrame({"cell": cells, "kind": 1, "key": batch["key"].to_numpy()[rows], "ids": None, "bound": kth[rows]})

    # The best kth distance of the parts of a query's own cell bounds the search of all others.
    bounds = asked.select("cell", "key").join(first.groupBy("key").agg(F.min("kth").alias("kth")), "key")
    second = _search_cells(stored.unionByName(bounds.mapInPandas(further, ROUTE_SCHEMA)), dim, most, k, stop)
    hits = first.select("key", "hits").unionByName(second.select("key", "hits"))
    order = lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1).when(x["vec_id"] < y["vec_id"], -1).when(x["vec_id"] > y["vec_id"], 1).otherwise(0)
    merged = hits.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("hits")), order).alias("hits"))
    ranked = queries.join(merged, "key").select("query_id", F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), F.lit(1), F.lit(k)).alias("hits"))
    answer = ranked.select("query_id", F.posexplode("hits").alias("at", "h")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score"))
    answer = steps.save(answer, "neighbours")
    steps.drop(routed, first, queries)
    return answer


def _boxes(stored: DataFrame, project, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of every cell's projected vectors: one row for each task and cell, then for each cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                p = project(batch["key"], False)
                for cell, rows in batch.groupby("cell").indices.items():
                    yield pd.DataFrame({"cell": cell, "axis": range(p.shape[1]), "low": p[rows].min(0), "high": p[rows].max(0)})

    rows = stored.select("cell", "key").mapInPandas(run, "cell int, axis int, low double, high double").groupBy("cell", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    axes = 1 + max((r.axis for r in rows), default=0)
    low, high = np.full((n_cells, axes), np.inf), np.full((n_cells, axes), -np.inf)
    for r in rows:
        low[r.cell, r.axis], high[r.cell, r.axis] = r.low, r.high
    return low, high


def _dealt(rows: DataFrame) -> DataFrame:
    """rows with the part of their cell and its copy: stored vectors go to one part and all copies of
    it, queries to all parts and one copy. There is a row for each cell in the table that says how many."""
    kind = F.col("kind")
    count = lambda which: F.count_if(kind == which)
    sizes = rows.groupBy("cell").agg(F.ceil(count(0) / CELL_ROWS).cast("int").alias("parts"), F.ceil(count(1) / CELL_QUERIES).cast("int").alias("copies"))
    of_key = lambda n: F.array(F.pmod(F.xxhash64("key"), F.greatest(F.col(n), F.lit(1))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1)
    placed = rows.join(F.broadcast(sizes), "cell")
    placed = placed.withColumn("part", F.explode(F.when(kind == 0, of_key("parts")).otherwise(every("parts"))))
    return placed.withColumn("copy", F.explode(F.when(kind == 0, every("copies")).otherwise(of_key("copies")))).drop("parts", "copies")


def _search_cells(rows: DataFrame, dim: int, most: float, k: int, stop: float) -> DataFrame:
    """Each part's stored vectors (about CELL_ROWS) answer the queries sent to it, batch by batch."""
    width = directions(dim)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, keys, ids, index, waiting = None, [], [], None, []

        def build():
            vectors = np.array([np.frombuffer(x) for x in keys])
            points = lift(vectors, most, query=False) @ width
            tree = KdTree(points, LEAF)
            tree.finish()
            return tree, vectors[tree.order], points[tree.order], [ids[i] for i in tree.order]

        def answer():
            nonlocal index, waiting
            block, waiting = waiting, []
            if not keys:
                return [(key, [], math.inf, 0) for key, _ in block]
            index = index or build()
            tree, vectors, points, members = index
            queries = np.array([np.frombuffer(key) for key, _ in block])
            bounds = np.array([bound for _, bound in block])
            out = []
            # One more than k, because the query's own vector is among the stored ones.
            results = search(tree, vectors, points, queries, lift(queries, most, query=True) @ width, most, k + 1, bounds, stop)
            for (key, _), (at, score, far2, verified) in zip(block, results, strict=True):
                keep = np.argsort(far2, kind="stable")
                # Ties at the last place count whole, so that smaller ids win.
                keep = keep[far2[keep] <= far2[keep[k]]] if len(keep) > k else keep
                hits = sorted(((-float(score[j]), i) for j in keep for i in members[at[j]]))[: k + 1]
                worst = float(far2[keep[k]]) if len(keep) > k else math.inf
                out.append((key, [{"vec_id": int(i), "score": -s} for s, i in hits], worst, verified))
            return out

        for batch in batches:
            out = []
            for own_place, kind, key, own, bound in zip(zip(batch["cell"], batch["part"], batch["copy"], strict=True), batch["kind"], batch["key"], batch["ids"], batch["bound"], strict=True):
                if own_place != place:
                    out += answer() if waiting else []
                    place, keys, ids, index = own_place, [], [], None
                if kind == 0:
                    keys.append(key)
                    ids.append(own)
                    continue
                waiting.append((key, bound))
                if len(waiting) == BLOCK:
                    out += answer()
            if out:
                yield pd.DataFrame(out, columns=["key", "hits", "kth", "verified"])
        if waiting:
            yield pd.DataFrame(answer(), columns=["key", "hits", "kth", "verified"])

    dealt = _dealt(rows).repartition("cell", "part", "copy").sortWithinPartitions("cell", "part", "copy", "kind", "key")
    return dealt.mapInPandas(run, FOUND_SCHEMA)
