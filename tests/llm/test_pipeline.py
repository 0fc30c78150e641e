"""Every stage of the pipeline, and all of them, against brute force on a small folder of tables."""

import collections

import corpus_pipeline
import pytest

from concordat.llm import queries, secrets, stages
from tests.llm.test_operators import RNG, WORDS, components_by_hand, quality_by_hand

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string"
SECRET = "9f3b7c01e8d24a6605bb19c4de72f08a3156e9cd"


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def rows():
    base = [prose(n) for n in (30, 80, 300, 2500)]
    near = base[1].split(" ")
    near[40] = "changed"
    texts = [None, "", "too short", *base, base[0], base[2], " ".join(near), f'{prose(40)} token = "{SECRET}" {prose(20)}', "\n".join([prose(6)] * 8), prose(15).upper()]
    made = [(i, t, "en" if i % 3 else None, "s", len(t or ""), "x") for i, t in enumerate(texts)]
    return [*made, (None, prose(25), "de", "s", 1, "x"), (4, base[1], None, "s", len(base[1]), "x")]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    place = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (3, 1, 0), (None, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return str(place)


def counted(rows):
    return collections.Counter((r[0], r[1]) for r in rows)


def by_hand(rows):
    """What each of the first three stages leaves, as (doc_id, text) pairs."""
    good = [r for r in rows if not quality_by_hand(r[1])[5]]
    named = components_by_hand(good, 5, 4, 5)
    seen, first = set(), []
    for r in good:
        if r[0] is None or named[r[0]][1] == r[0] and r[0] not in seen:
            first.append(r)
            seen.add(r[0])
    clean = [(r[0], r[1].replace(SECRET, secrets.MARK)) for r in first]
    return good, first, clean


def test_stages(spark, folder, rows):
    good, first, clean = by_hand(rows)
    assert len(rows) > len(good) > len(first) > 5
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = list(stages.COLUMNS)
    got = stages.quality_rules(spark, docs, folder)
    assert got.columns == columns and counted(got.collect()) == counted(good)
    got = stages.near_duplicates(spark, spark.createDataFrame(good, COLUMNS), folder)
    assert got.columns == columns and counted(got.collect()) == counted(first)
    got = stages.secret_scans(spark, spark.createDataFrame(first, COLUMNS), folder)
    assert got.columns == columns and counted(got.collect()) == counted(clean) and all(r.n_chars == len(r.text) for r in got.collect())


def test_run_packs_what_the_stages_leave(spark, folder, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary())
    want = collections.Counter((i, len(library.encode(t, add_special_tokens=False).ids) + 1) for i, t in by_hand(rows)[2])
    pieces = corpus_pipeline.run(spark, folder).collect()
    got, held = collections.Counter(), collections.defaultdict(list)
    for p in pieces:
        got[p.doc_id] += p.length
        held[p.sequence_id].append((p.offset, p.length))
    assert collections.Counter(got.items()) == want
    for own in held.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_take_empty_tables(spark, folder):
    none = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
