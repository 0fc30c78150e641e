"""Control documents, runtime versions and strict arguments."""

import hashlib
import json
import types

import pytest

from concordat.__main__ import main
from concordat.session import guard
from concordat.sources import documents


def _refused(spark, path, why):
    with pytest.raises(ValueError, match=why):
        documents.read_document(spark, str(path))


def test_one_small_strict_object(spark, tmp_path):
    text = json.dumps({"é": [1, {"b": None}], "run_id": "r"}, ensure_ascii=False)
    (tmp_path / "d.json").write_text(text, encoding="utf-8")
    found = documents.read_document(spark, str(tmp_path / "d.json"))
    assert found.content == json.loads(text)
    assert (found.size_bytes, found.sha256) == (len(text.encode()), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize(("content", "why"), [
    (b"", "no row"), (b"{", "MALFORMED"), (b"[1]", "NOT_AN_OBJECT"), (b'{"a":1.5}', "NOT_AN_INTEGER"), (b'{"a":NaN}', "NOT_A_NUMBER"), (b'{"a":1,"a":2}', "REPEATED_NAME"), (b'{"a":9223372036854775808}', "INTEGER_RANGE"),
    (b'{"a":"\xff"}', "UTF-8"), (b'{"a":' + b"[" * 40 + b"]" * 40 + b"}", "TOO_DEEP"), (b'{"a":"' + b"x" * documents.MOST_BYTES + b'"}', "the bound is"),
])
def test_other_documents_are_refused(spark, tmp_path, content, why):
    (tmp_path / "d.json").write_bytes(content)
    _refused(spark, tmp_path / "d.json", why)


def test_none_and_several(spark, tmp_path):
    _refused(spark, tmp_path / "none.json", "can't be read")
    for name in "ab":
        (tmp_path / f"{name}.json").write_text("{}")
    _refused(spark, tmp_path, "several rows")
    with pytest.raises(ValueError, match="no row"):
        documents.single(spark.range(0), "it")
    assert documents.single(spark.range(1), "it").id == 0


def test_depth_counts_nested_values():
    nested = {"a": [{"b": []}], "c": 1}
    assert documents.depth(nested) == 4
    assert documents.depth(1) == 0
    deep = []
    for _ in range(100_000):
        deep = [deep]
    assert documents.depth(deep) == documents.MOST_DEPTH + 1
    while deep:  # unwound by hand: freeing it at once would recurse
        deep = deep[0]


def test_old_runtimes_are_refused():
    with pytest.raises(RuntimeError, match="EXECUTION_ENVIRONMENT"):
        guard(types.SimpleNamespace(version="3.5.6"))


@pytest.mark.parametrize("more", [
    ["--attempt", "a", "--attempt", "b"], ["--att", "a"], ["--attempt", "a b"], ["--attempt", ""], ["--attempt", "a", "--head", "XYZ"], ["--attempt", "a", "--other", "b"], [],
])
def test_arguments_are_strict(spark, more):
    with pytest.raises(SystemExit):
        main(["finalize", "manifest", "root", "policy", "out", *more], spark)
