"""Pairs that the pivots of the Jaccard join leave: each is met once a pivot, and all of them are settled."""

import random

import numpy as np
import pytest

from concordat.llm import similarity
from tests.llm.test_operators import components_by_hand

RNG = random.Random(11)
DOCS = "doc_id long, text string"


def words(n):
    return ["".join(RNG.choices("abcdefghijklmnop", k=7)) for _ in range(n)]


def changed(base, places):
    return " ".join(f"new{RNG.getrandbits(40)}" if i in places else w for i, w in enumerate(base))


def near_copies():
    """Copies of one text, each changed in its own 3 to 12 places: about half are similar to the first one."""
    base = words(300)
    return [(i, changed(base, set(RNG.sample(range(300), 3 + i % 10)))) for i in range(60)]


def hub():
    """A long text of 20 passages and six copies of each passage, which it isn't similar to."""
    passages = [words(60) for _ in range(20)]
    copies = [changed(p, {RNG.randrange(60) if j < 3 else RNG.choice((0, 59))}) for p in passages for j in range(6)]
    return [(0, " ".join(w for p in passages for w in p)), *((1 + i, t) for i, t in enumerate(copies))]


def check(spark, rows):
    got = similarity.linked(spark.createDataFrame(rows, DOCS), 5, 4, 5).collect()
    want = components_by_hand(rows, 5, 4, 5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    return len({c for _, c in want.values()})


def test_near_copies_meet_once(spark, monkeypatch):
    """Near copies share many keys; what is left after the pivots meets once, not once a key."""
    made, possible = [], similarity._possible
    monkeypatch.setattr(similarity, "_possible", lambda *a: made.append((found := possible(*a)).count()) or found)
    rows = near_copies()
    assert 1 < check(spark, rows) < len(rows)
    assert 0 < made[-1] <= len(rows) * (len(rows) - 1) // 2


@pytest.mark.parametrize("make", [near_copies, hub])
def test_groups_by_pivot_by_key_and_in_chunks(spark, monkeypatch, make):
    """Where a pivot's members are more pairs than its keys' are, they meet by key; chunks leave no pair out."""
    monkeypatch.setattr(similarity, "PIVOT_PAIRS", 0)
    monkeypatch.setattr(similarity, "CHUNK", 4)
    split, members = [], similarity._members
    monkeypatch.setattr(similarity, "_members", lambda *a: split.append((found := members(*a)).where("key <> 0").count()) or found)
    rows = make()
    assert check(spark, rows) > 1
    assert (split[0] > 0) == (make is hub)


def test_wide_sketches(spark):
    """A wide sketch rules out large sets that a full narrow one can't, and no similar sets of other widths."""
    new = np.random.default_rng(3)
    draw = lambda n: new.integers(0, 1 << 63, n, dtype=np.uint64)
    base = draw(4000)
    sets = {1: base, 2: np.concatenate((base[:-700], draw(700))), 3: np.concatenate((base[:-380], draw(380))), 4: np.concatenate((base, draw(900))), 5: draw(100), 6: np.concatenate((base, draw(250)))}
    nodes = []
    for i, tokens in sets.items():
        wide = similarity.wide_sketch(tokens)
        assert len(wide) * 64 >= max(512, 4 * len(tokens))
        assert (similarity.narrowed(wide) == similarity.parity_sketch(tokens)).all()
        nodes.append((i, len(tokens), similarity.narrowed(wide).tolist(), wide.tolist()))
    nodes = spark.createDataFrame(nodes, "doc_id long, n long, sketch array<long>, wide array<long>")
    pairs = spark.createDataFrame([(b, a) for a in sets for b in sets if a < b and 5 not in (a, b)], "a long, b long")
    left = {(r.b, r.a) for r in similarity._sharpened(pairs, nodes, 4, 5).collect()}
    similar = {(a, b) for a in sets for b in sets if a < b and similarity.jaccard(sets[a].tolist(), sets[b].tolist()) >= 0.8}
    assert {(1, 3), (1, 4), (1, 6)} <= similar <= left
    assert len(sets[1]) * 4 <= 1 << 14 < len(sets[4]) * 4 and (1, 2) not in left
