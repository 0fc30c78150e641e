"""Digest trees: independence of partitions, a root by hand, located differences, published tables."""

import hashlib
import json
import random
import shutil
from pathlib import Path

import pytest

from concordat.operators import digests

SCHEMA = "a string, b bigint, note string"


def digest(value):
    return hashlib.sha256(json.dumps(value, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def root_by_hand(rows, depth):
    items = {}
    for a, b, note in rows:
        place = digest({k: v for k, v in (("a", a), ("b", b)) if v is not None})
        items.setdefault(place, []).append(digest({k: v for k, v in (("a", a), ("b", b), ("note", note)) if v is not None}))
    nodes = {}
    for place in sorted(items):
        own = items[place]
        nodes.setdefault(place[:depth], []).append(f"{place} {min(own)} {max(own)} {len(own)}\n")
    for level in range(depth, 0, -1):
        nodes = {n: hashlib.sha256("".join(x).encode()).hexdigest() for n, x in nodes.items()}
        above = {}
        for n in sorted(nodes):
            above.setdefault(n[: level - 1], []).append(f"{n} {nodes[n]}\n")
        nodes = above
    return hashlib.sha256("".join(nodes[""]).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return [(f"k{i}", None if i % 7 == 0 else i, rng.choice(["x", None, "ü"])) for i in range(700)]


def test_root_does_not_depend_on_partitions(spark, rows):
    df = spark.createDataFrame([*rows, rows[3], rows[3]], SCHEMA)
    roots = set()
    for n in (1, 8, 64):
        nodes = digests.tree(digests.leaves(digests.placed(df.repartition(n), ("a", "b")), 2), 2)
        root = nodes.where("level = 0").first()
        roots.add((root.digest, root.n_rows, root.n_places))
    assert roots == {(root_by_hand([*rows, rows[3], rows[3]], 2), 702, 700)}
    assert digests.tree(digests.leaves(digests.placed(df.limit(0), ("a", "b")), 2), 2).isEmpty()
    assert (digests.depth_for(10), digests.depth_for(10**6), digests.depth_for(10**12)) == (1, 2, 7)


def changed(rows):
    out = [(a, b, "new" if i == 11 else note) for i, (a, b, note) in enumerate(rows) if i not in (5, 300)]
    return [*out, ("k9000", 1, None)]


def by_hand(expected, actual):
    x, y = ({(a, b): note for a, b, note in rows} for rows in (expected, actual))
    side = lambda k: "missing" if k not in y else "extra" if k not in x else "changed"
    return {(*k, side(k)) for k in x.keys() | y.keys() if k not in x or k not in y or x[k] != y[k]}


def test_located_differences(spark, rows):
    one, two = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(changed(rows), SCHEMA)
    found = digests.located(one, two.select("note", "b", "a"), ("a", "b"), 2)
    want = by_hand(rows, changed(rows))
    assert {tuple(r) for r in found.collect()} == want and len(want) == 4
    assert tuple(digests.first_difference(found, ("a", "b"))[0]) == min(want, key=lambda r: (r[0], r[1] is not None, r[1] or 0))
    assert digests.first_difference(digests.located(one, one.repartition(5), ("a", "b"), 2), ("a",)) == []
    assert digests.located(one, one.limit(0), ("a", "b"), 2).where("side = 'missing'").count() == 700
    with pytest.raises(ValueError, match="DUPLICATE_IDENTITY: k4 4 stands 3 times"):
        digests.located(one, spark.createDataFrame([*rows, rows[4], rows[4]], SCHEMA), ("a", "b"), 2)


def test_only_unequal_blocks_of_published_tables_are_read(spark, rows, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    digests.publish(spark.createDataFrame(rows, SCHEMA), one, ("a", "b"), 3)
    digests.publish(spark.createDataFrame(changed(rows), SCHEMA), two, ("a", "b"), 3)
    want = by_hand(rows, changed(rows))
    blocks = {f"block=x{digest({k: v for k, v in (('a', a), ('b', b)) if v is not None})[:2]}" for a, b, _ in want}
    spoiled = 0
    for place in (one, two):
        for folder in Path(place, "rows").glob("block=*"):
            if folder.name not in blocks:
                shutil.rmtree(folder)  # a block that is equal by its digest is never opened
                spoiled += 1
    assert spoiled > 300
    found, descent = digests.located_between(spark, one, two, ("a", "b"), 3)
    assert {tuple(r) for r in found.collect()} == want
    levels = {r.level: (r.n_nodes, r.n_unequal) for r in descent.collect()}
    assert levels[0] == (1, 1) and levels[2][1] == len(blocks) and levels[3][1] == 4 and levels[2][0] > 200
    with pytest.raises(ValueError, match="depth"):
        digests.publish(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "three"), ("a", "b"), 1)
