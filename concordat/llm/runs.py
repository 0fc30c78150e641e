"""Periodic runs of words by Karp-Miller-Rosenberg naming, in NumPy inside mapInPandas.

A run is a stretch of words with smallest period q and a length of at least max(6, 4 q) that no
neighbouring word extends. Documents are taken in groups of about ``GROUP_WORDS`` words, longest
first, laid one after another as word numbers that differ from document to document, so nothing is
equal across documents. Names of level k stand for 2^k words: two positions have the same name of
level k + 1 if their names of level k and those 2^k further on agree. A name that stands once can be
equal to no other and becomes 0, and is left out of all higher levels.

A run of period q covers, from its first multiple g of q on, the q words at g, g + q and g + 2 q, all
equal. So for each q only the positions g = 0, q, 2 q, ... are tested (n / q of them, n log n for
all q), each by the two names of level floor(log2 q) that cover q words; the first of a chain of equal
neighbours is a candidate. It is extended by longest common extensions, forwards and backwards, each
by descending name levels. Two candidates with the same ends are one run with the smaller period.
No fingerprints and no suffix order are used, so all results are exact.

Memory is a few numbers a word of a group for each level at which names still repeat; a text longer
than a group is a group of its own. No text leaves its row and nothing is shuffled.

Defined results: null, empty and blank texts have no words, no runs and the digests of empty texts;
rows that repeat, and rows without doc_id, count each; a null doc_id is never rewritten. Ties for the
strongest run go to the smaller start, then period. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

LEAST_LENGTH = 6
LEAST_PERIODS = 4
GROUP_WORDS = 1 << 18
WORD = re.compile(r"[^\x20\x09-\x0D]+")
Rewrite = Callable[[int | None, int], np.ndarray | None]
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
SPANS_SCHEMA = "doc_id long, start long, length long, period long"


def tenth_made_periodic(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of all ids, the original word number of each word: from word a on, p words repeat."""
    if doc_id is None or not n:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


@dataclass
class Names:
    """Names of every level over documents laid one after another; 0: the words there stand nowhere else."""

    words: np.ndarray  # numbers from 1; equal words of one document have one number, words of two documents never
    levels: list[np.ndarray] = field(init=False)

    def __post_init__(self):
        n = len(self.words)
        counts = np.bincount(self.words, minlength=1)
        self.levels = [np.where(counts[self.words] > 1, self.words, 0).astype(np.int32)]
        while True:
            step = 1 << (len(self.levels) - 1)
            last = self.levels[-1]
            at = np.flatnonzero((last[: n - step] > 0) & (last[step:] > 0)) if n > step else np.empty(0, np.int64)
            pair = (last[at].astype(np.int64) << 32) | last[at + step]
            _, name, count = np.unique(pair, return_inverse=True, return_counts=True)
            keep = count[name] > 1
            if not keep.any():
                break
            new = np.zeros(n, np.int32)
            new[at[keep]] = name[keep] + 1
            self.levels.append(new)

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x and from y on are equal, for x < y.

        Each level is met once: twice the longest names that repeat would be a name that repeats.
        """
        n, total = len(self.words), np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[k], 1 << k
            todo = np.flatnonzero(y + total + step <= n)
            a, b = names[x[todo] + total[todo]], names[y[todo] + total[todo]]
            total[todo[(a > 0) & (a == b)]] += step
        return total

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before x and before y are equal, for x < y."""
        total = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[k], 1 << k
            todo = np.flatnonzero(x - total >= step)
            a, b = names[x[todo] - total[todo] - step], names[y[todo] - total[todo] - step]
            total[todo[(a > 0) & (a == b)]] += step
        return total


def _candidates(names: Names, bounds: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Rows (place, q) for the periods q from 2^k to 2^(k+1) - 1: firsts of chains of equal blocks of q words.

    Only documents that are long enough and in which a name of the level repeats are looked at.
    """
    level, step, sizes = names.levels[k], 1 << k, np.diff(bounds)
    live = np.flatnonzero((sizes >= max(LEAST_LENGTH, LEAST_PERIODS * step)) & (np.add.reduceat(level > 0, bounds[:-1]) > 0))
    if not len(live):
        return
    packed = np.concatenate([level[bounds[d] : bounds[d + 1]] for d in live])
    place = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in live])
    for q in range(step, min(2 * step, int(sizes[live].max()) // LEAST_PERIODS + 1)):
        head, tail = packed[::q], packed[q - step :: q]
        m = min(len(head), len(tail)) - 1
        if m < 2:
            continue
        same = (head[:m] == head[1 : m + 1]) & (tail[:m] == tail[1 : m + 1]) & (head[:m] > 0) & (tail[:m] > 0)
        chain = same[:-1] & same[1:]
        chain[1:] &= ~same[:-2]
        at = np.flatnonzero(chain) * q
        if len(at):
            yield np.stack([place[at], np.full(len(at), q)], axis=1)


def find_runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period; bounds: the documents' ends, none empty."""
    names = Names(words)
    found = [c for k in range(len(names.levels)) for c in _candidates(names, bounds, k)]
    if not found:
        return np.empty((0, 3), np.int64)
    grid = np.concatenate(found)
    x, q = grid[:, 0], grid[:, 1]
    back = names.backward(x, x + q)
    start, length = x - back, back + q + names.forward(x, x + q)
    good = length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * q)
    runs = np.stack([start, length, q], axis=1)[good]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbered(documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of documents laid one after another, and their bounds."""
    out, used = [], 1
    for words in documents:
        number: dict[str, int] = {}
        own = [number.setdefault(w, len(number)) for w in words]
        out.append(np.array(own, np.int64) + used)
        used += len(number)
    return np.concatenate(out), np.concatenate([[0], np.cumsum([len(w) for w in documents])])


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _kept(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words outside of all runs or among the first q of each run that holds them."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not covered]


Found = tuple[list[str], list[tuple[int, int, int]]]


def runs_of(texts: list[str | None], ids: list[int | None], rewrite: Rewrite | None = None) -> Iterator[tuple[int, Found]]:
    """(number of the text, (its words after rewriting, its runs)), group by group."""
    cut: list[tuple[int, list[str]]] = []
    size = 0

    def solve(group: list[tuple[int, list[str]]]) -> Iterator[tuple[int, Found]]:
        full = sorted((g for g in group if len(g[1]) >= LEAST_LENGTH), key=lambda g: -len(g[1]))
        yield from ((i, (words, [])) for i, words in group if len(words) < LEAST_LENGTH)
        if full:
            numbers, bounds = _numbered([w for _, w in full])
            runs = find_runs(numbers, bounds)
            owner = np.searchsorted(bounds, runs[:, 0], side="right") - 1
            ends = np.searchsorted(owner, np.arange(len(full) + 1))
            for d, (i, words) in enumerate(full):
                own = runs[ends[d] : ends[d + 1]]
                yield i, (words, [(s - int(bounds[d]), n, q) for s, n, q in own.tolist()])

    for i, text in enumerate(texts):
        words = WORD.findall(text) if text else []
        at = rewrite(ids[i], len(words)) if rewrite else None
        if at is not None:
            words = [words[j] for j in at.tolist()]
        cut.append((i, words))
        size += len(words)
        if size >= GROUP_WORDS:
            yield from solve(cut)
            cut, size = [], 0
    yield from solve(cut)


def _ids(column: pd.Series) -> list[int | None]:
    return [None if pd.isna(i) else int(i) for i in column]


def _texts(column: pd.Series) -> list[str | None]:
    return [t if isinstance(t, str) else None for t in column]


def periodic_runs(documents: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """One row per document: its runs' number and digest, its strongest run, and the digest of its collapsed text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = _ids(batch["doc_id"])
            out = []
            for i, (words, runs) in runs_of(_texts(batch["text"]), ids, rewrite):
                best = _strongest(runs)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                out.append((
                    ids[i], len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                    hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(_kept(words, runs)).encode()).hexdigest(),
                ))
            frame = pd.DataFrame(out, columns=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])
            yield frame.astype({c: "Int64" for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")})

    return documents.select("doc_id", "text").mapInPandas(run, SCHEMA)


def run_spans(documents: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, start, length, period) of every run, in words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = _ids(batch["doc_id"])
            out = [(ids[i], *r) for i, (_, runs) in runs_of(_texts(batch["text"]), ids, rewrite) for r in runs]
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "period"]).astype("Int64")

    return documents.select("doc_id", "text").mapInPandas(run, SPANS_SCHEMA)


def collapsed(documents: DataFrame) -> DataFrame:
    """(doc_id, text): texts with every run cut down to its first period, words joined by one space; null stays null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = _texts(batch["text"]), _ids(batch["doc_id"])
            out = [(ids[i], None if texts[i] is None else " ".join(_kept(words, runs))) for i, (words, runs) in runs_of(texts, ids)]
            yield pd.DataFrame(out, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id long, text string")
