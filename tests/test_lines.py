"""Line numbers of files that are split over several tasks."""

import collections
import random

from pyspark.sql import functions as F

from concordat.sources import lines


def test_line_numbers(spark, tmp_path):
    rng, texts = random.Random(7), {}
    for name, n in (("b", 4000), ("a", 700), ("empty", 0), ("one", 1)):
        texts[name] = [f"{name}{rng.randint(0, 50)}" + "x" * rng.choice([0, 3, 90]) for _ in range(n)]
        (tmp_path / name).write_text("\n".join(texts[name]) + ("\n" if n and name != "a" else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        paths = [str(tmp_path / n) for n in texts]
        assert spark.read.text(paths).rdd.getNumPartitions() > 20
        rows = lines.numbered(spark, [*paths, paths[0]], value=F.col("value"))
        got = [(r.path.rpartition("/")[2], r.line, r.value, r.position) for r in rows.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want, at = [], 0
    for name in sorted(texts):
        for i, text in enumerate(texts[name], 1):
            at += 1
            want.append((name, i, text, at))
    assert sorted(got) == sorted(want)
    seen = collections.Counter()
    inventory = {(r.path.rpartition("/")[2], r.line): (r.occurrence, r.replayed) for r in lines.occurrences(rows, ("value",)).collect()}
    for name, line, text, _ in want:
        seen[text] += 1
        assert inventory[name, line] == (seen[text], seen[text] > 1)


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty").write_text("")
    assert lines.numbered(spark, [str(tmp_path / "empty")], value=F.col("value")).isEmpty()
