"""Periodic runs against brute force, with nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from concordat.llm import runs

RNG = random.Random(8)
DOCS = "doc_id long, text string, start long, n_runs string"


def by_hand(words):
    """All runs of a list of words, from the definition: maximal stretches of each period, those of a smaller period left out."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted(((s, n_, q) for (s, n_), q in found.items()), key=lambda r: (r[0], r[2]))


def row_by_hand(doc_id, text, rewritten=True):
    words = runs.WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if rewritten and doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = by_hand(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = sorted(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(found), *(best[0] if best else (None,) * 3), 1000 * best[0][1] // best[0][2] if best else None, digest(listed), digest(kept))


def test_find_runs_equals_brute_force():
    for trial in range(1500):
        documents = []
        for _ in range(RNG.randint(1, 5)):
            words = RNG.choices("abcd"[: RNG.randint(1, 4)], k=RNG.randint(1, 90))
            for _ in range(RNG.randint(0, 3)):
                block = RNG.choices("abcde", k=RNG.randint(1, 9)) * RNG.randint(3, 7)
                at = RNG.randint(0, len(words))
                words[at:at] = block[: len(block) - RNG.randint(0, 3)]
            documents.append(words)
        numbers, bounds = runs._numbered(documents)
        got = runs.find_runs(numbers, bounds).tolist()
        want = [[s + int(b), n, q] for d, b in zip(documents, bounds, strict=False) for s, n, q in by_hand(d)]
        assert got == want, trial


def test_extensions():
    words = np.array([1, 2, 1, 2, 1, 3, 1, 2, 1, 2, 1, 2, 4])
    names = runs.Names(words)
    x, y = (np.array(v) for v in zip(*[(a, b) for a in range(13) for b in range(a + 1, 13)], strict=True))
    same = lambda step: [next((k for k in range(20) if not (0 <= a + (step * k if step > 0 else -k - 1) and b + step * k + (0 if step > 0 else -1) < 13 and words[a + (k if step > 0 else -k - 1)] == words[b + (k if step > 0 else -k - 1)])), 20) for a, b in zip(x, y, strict=True)]
    assert names.forward(x, y).tolist() == same(1)
    assert names.backward(x, y).tolist() == same(-1)


def tables():
    prose = lambda n: " ".join(RNG.choices([f"w{i}" for i in range(400)], k=n))
    texts = [None, "", " \t\n", "a", "a b a b a b a b", "x\n" * 6, "x " * 5, "é é " * 4 + "é é\x85", "q w e " * 5 + "q w r", prose(3000), prose(40) + " again and" * 30 + " " + prose(9), "z " * 5000]
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    made = [(i, t, 1, "c") for i, t in enumerate(texts, 3000)]
    made += [(i, prose(RNG.choice([1, 2, 5, 30, 200, 900])), None, "c") for i in ids] + [(ids[0], None, 1, ""), (ids[1], "", 1, ""), (ids[2], "one", 1, "")]
    return [*made, made[4], (None, "a b " * 9, 1, None)]


def test_periodic_runs(spark):
    rows = tables()
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    want = collections.Counter((i, *row_by_hand(i, t)) for i, t, *_ in rows)
    got = runs.periodic_runs(df, rewrite=runs.tenth_made_periodic)
    assert got.columns == [c.split(" ")[0] for c in runs.SCHEMA.split(", ")]
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert sum(r[1] > 0 for r in want) > 8
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_groups_do_not_change_results(monkeypatch):
    rows = tables()
    texts, ids = [r[1] for r in rows], [r[0] for r in rows]
    whole = dict(runs.runs_of(texts, ids, runs.tenth_made_periodic))
    monkeypatch.setattr(runs, "GROUP_WORDS", 50)
    assert dict(runs.runs_of(texts, ids, runs.tenth_made_periodic)) == whole


def test_spans_and_collapsed_texts(spark):
    rows = tables()
    df = spark.createDataFrame(rows, DOCS).repartition(2)
    want = collections.Counter((i, *r) for i, t, *_ in rows for r in by_hand(runs.WORD.findall(t or "")))
    assert collections.Counter(tuple(r) for r in runs.run_spans(df).collect()) == want
    got = collections.Counter((r.doc_id, r.text is None, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in runs.collapsed(df).collect())
    assert got == collections.Counter((i, t is None, row_by_hand(i, t, rewritten=False)[-1]) for i, t, *_ in rows)


def test_long_text_is_linear_in_memory_and_near_linear_in_time():
    rng = np.random.default_rng(4)
    period = rng.integers(0, 5000, 30_000)
    words = np.concatenate([rng.integers(0, 5000, 100_000), np.tile(period, 9)])
    _, numbers = np.unique(words, return_inverse=True)
    got = runs.find_runs(numbers + 1, np.array([0, len(words)]))
    assert [q for _, _, q in got.tolist() if q > 5] == [30_000]
    assert got[-1].tolist()[1] >= 270_000
