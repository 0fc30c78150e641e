"""Source objects, bundles, the log and the command line."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from concordat.__main__ import main
from concordat.operators.policy import read_policy
from concordat.sources import files, publication
from tests import records

POLICY = records.policy()
RULES = read_policy(POLICY)
EVENT = records.event()


def bundle(folder, **texts):
    return records.bundle(folder, POLICY, [EVENT], [records.journal()], [records.settlement()], [records.bank("k,1", reference=None)], texts=texts)


def admit(spark, folder, **texts):
    return files.admit_bundle(spark, bundle(folder, **texts), folder, RULES)


def test_families_are_read(spark, tmp_path):
    found = admit(spark, tmp_path)
    assert {f: d.count() for f, d in found.items()} == dict.fromkeys(files.FAMILIES, 1)
    row = found["BANK_ENTRIES"].first()
    assert (row.bank_record_id, row.settlement_reference, row.amount_minor) == ("k,1", None, 99)
    assert found["LEDGER_JOURNALS"].first().postings[1].amount_minor == 100


def test_records_are_parsed_once(spark, tmp_path):
    found = admit(spark, tmp_path)
    for df in found.values():
        plan = df._jdf.queryExecution().toString()
        assert "FileScan parquet" in plan and "FileScan json" not in plan and "FileScan csv" not in plan
    files.release(found)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        spark.read.parquet(*found["BANK_ENTRIES"].inputFiles()).count()
    assert not [f for df in found.values() for f in df.inputFiles() if f.startswith("file:") and Path(f.removeprefix("file://")).exists()]


def test_object_without_records(spark, tmp_path):
    found = admit(spark, tmp_path, PROCESSOR_EVENTS="\n")
    assert found["PROCESSOR_EVENTS"].where("source_record_id IS NOT NULL").count() == 0


@pytest.mark.parametrize(("text", "detail"), [
    (json.dumps(EVENT) + "\r\n", "carriage return"),
    (json.dumps(EVENT) + "\n\n", "empty record"),
    (b"\xef\xbb\xbf" + json.dumps(EVENT).encode() + b"\n", "byte order mark"),
    (b'{"a": "\xff"}\n', "invalid UTF-8"),
    ('{"a": 1, "a": 2}\n', "REPEATED_NAME"),
    ('{"a": 1.5}\n', "NOT_AN_INTEGER"),
    ('{"a": 9223372036854775808}\n', "INTEGER_RANGE"),
    ('{"a": NaN}\n', "NOT_A_NUMBER"),
    ("[1]\n", "NOT_AN_OBJECT"),
    ("{\n", "MALFORMED"),
    (json.dumps(EVENT | {"amount_major": 1}) + "\n", "UNKNOWN_FIELD amount_major"),
])
def test_bad_lines_are_refused(spark, tmp_path, text, detail):
    with pytest.raises(ValueError, match=detail):
        admit(spark, tmp_path, PROCESSOR_EVENTS=text)


@pytest.mark.parametrize(("field", "value", "detail"), [("size_bytes", 3, "size"), ("sha256", "0" * 64, "digest"), ("record_count", 2, "record count")])
def test_identity_is_checked(spark, tmp_path, field, value, detail):
    manifest = bundle(tmp_path)
    manifest["objects"][0][field] = value
    with pytest.raises(ValueError, match="manifest digest"):
        files.admit_bundle(spark, manifest, tmp_path, RULES)
    with pytest.raises(ValueError, match=detail):
        files.admit_bundle(spark, records.bound({k: v for k, v in manifest.items() if k != "manifest_sha256"}), tmp_path, RULES)


LINES = [
    '{"b":1,"a":[{"x":2}]}', '{"a":1,"a":2}', '{"a":1.5}', '{"a":9223372036854775808}', '{"a":NaN}', "[1]", "{", '{"a":1} {"b":2}', '{"a":1}x', '{"a":1e2}', '{"a":1.0}', '{"é":1}', '{"a":"\\u00e9\\n\\/"}', ' {"a":1} ', '{"a":"\\ud800"}',
    '{"a":-0}', '{"a":01}', "null", '"x"', '{"a":"x\ty"}', '{"a":true,"b":null}', '{"a":123456789012345678901234567890123456789012}', '{"a":1,}', "{'a':1}", '{"a":"A\u0301","\\u0061":2}', '{"a":1},{"b":2}', '{"a":1}] [{}',
    '{"é":1,"e\u0301":2}', '{"DECIMAL":1}', '{"a":[1.5,"x"]}', '{"a":[1,"x"]}', '{"a":{"b":[]}}', "{}", '{"a":-9223372036854775808}', '{"a":Infinity}', '{"a":"' + "y" * 5000 + '"}', '{"a":' * 1200 + "1" + "}" * 1200,
]


def test_jvm_and_parser_agree_on_every_line(spark, tmp_path):
    """Only doubtful lines reach the parser, and none of the lines that the JVM lets pass has a fault."""
    frame = spark.createDataFrame(list(enumerate(LINES)), "i int, value string")
    passed = {r.i for r in frame.where(files.plainly_strict(F.col("value"))).collect()}
    sound = {i for i, line in enumerate(LINES) if files.strict_fault(line) is None}
    assert passed <= sound and {0, 12, 13, 20, 31, 32, 33, 35} <= passed
    (tmp_path / "bad").write_text("\n".join(LINES) + "\n")
    (tmp_path / "good").write_text("\n".join(LINES[i] for i in sorted(passed)) + "\n")
    found = files.strict_faults(spark, [str(tmp_path / "bad")])
    assert sorted(r.fault for r in found.collect()) == sorted(f for line in LINES if (f := files.strict_fault(line)))
    clean = files.strict_faults(spark, [str(tmp_path / "good")])
    assert clean.isEmpty() and "Python" not in clean._jdf.queryExecution().toString() and "Pandas" not in clean._jdf.queryExecution().toString()


def test_postings_are_closed_too(spark, tmp_path):
    own = records.journal()
    changed = own | {"postings": [own["postings"][0] | {"note": "x"}, own["postings"][1]]}
    with pytest.raises(ValueError, match="UNKNOWN_FIELD note"):
        admit(spark, tmp_path, LEDGER_JOURNALS=json.dumps({k: v for k, v in changed.items() if v is not None}) + "\n")


def test_canonical_form(spark, tmp_path):
    good = ['{"a":[{"x":2}],"b":1}', '{"a":"é\\n"}', "{}"]
    for name, lines, n in (("good", good, 0), ("bad", ['{"b":1,"a":2}', '{"a": 1}', '{"a":"\\u00e9"}', '{"a":1}x', "{", *good], 5)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        assert files.canonical_faults(spark, [str(tmp_path / name)]).count() == n
    sorted_text = json.dumps({k: v for k, v in EVENT.items() if v is not None}, sort_keys=True, separators=(",", ":")) + "\n"
    journal_text = json.dumps({k: v for k, v in records.journal().items() if v is not None}, sort_keys=True, separators=(",", ":")) + "\n"
    for texts, fits in (({"PROCESSOR_EVENTS": sorted_text, "LEDGER_JOURNALS": journal_text}, True), ({"LEDGER_JOURNALS": journal_text}, False)):
        manifest = bundle(tmp_path / str(fits), **texts)
        if fits:
            assert files.admit_bundle(spark, manifest, tmp_path / str(fits), RULES, canonical=True)["PROCESSOR_EVENTS"].count() == 1
        else:
            with pytest.raises(ValueError, match="NOT_CANONICAL"):
                files.admit_bundle(spark, manifest, tmp_path / str(fits), RULES, canonical=True)


def test_composed_and_decomposed_names_collide():
    assert files.strict_fault('{"\u00e9": 1, "e\u0301": 2}') == "REPEATED_NAME"
    assert files.strict_fault('{"a": {"b": -9223372036854775808}}') is None


def test_paths_are_confined(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").write_text("x")
    (tmp_path / "in/link").symlink_to(tmp_path / "out")
    for name in ("../out", str(tmp_path / "out"), "link", "none", ""):
        with pytest.raises(ValueError):
            files.confined(tmp_path / "in", name)
    assert files.locator({"locator_type": "S3_OBJECT", "s3_uri": "s3://b/k", "version_id": "v"}) == "s3:s3://b/k#v"
    with pytest.raises(ValueError):
        files.locator({"locator_type": "S3_OBJECT", "s3_uri": "s3://b/k"})


def test_bundle_round_trip_and_change(spark, tmp_path):
    frame, place = spark.range(10), str(tmp_path / "b")
    digest = publication.write_bundle(spark, {"t": frame}, place, {"run_id": "r"})
    assert sorted(r.id for r in publication.open_bundle(spark, place, digest)["t"].collect()) == list(range(10))
    with pytest.raises(FileExistsError):
        publication.write_bundle(spark, {"t": frame}, place, {"run_id": "r"})
    part = next((tmp_path / "b/t").glob("part-*.parquet"))
    part.write_bytes(part.read_bytes()[:-1] + b"x")
    for crc in list((tmp_path / "b/t").glob(".*.crc")):
        crc.unlink()
    with pytest.raises(ValueError, match="differ"):
        publication.open_bundle(spark, place)


def test_log(spark, tmp_path):
    log = publication.History(spark, str(tmp_path / "log"))
    first = log.finalize("a1", {"t": spark.range(3)}, {"run_id": "r1"}, None)
    assert log.finalize("a1", {"t": spark.range(3)}, {"run_id": "r1"}, None) == first
    with pytest.raises(ValueError, match="moved"):
        log.finalize("a2", {"t": spark.range(4)}, {"run_id": "r2"}, None)
    # An attempt that ended after its bundle goes on with it.
    publication.write_bundle(spark, {"t": spark.range(5)}, f"{log.files.root}/bundles/a3", {"run_id": "r3"})
    log.finalize("a3", {"t": spark.range(9)}, {"run_id": "r3"}, first["sha256"])
    assert (log.verify(), log.state()["t"].count(), log.attempt("a3")["number"]) == (2, 5, 2)
    with pytest.raises(FileExistsError):
        log.files.put("log/000000002.json", b"x")


def test_shards(spark, tmp_path):
    listed = publication.write_shards(spark.range(10), str(tmp_path / "s"), "json", 4, ("id",))
    assert [(f["first_index"], f["last_index"]) for f in listed][-1][1] == 9 and all(f["size_bytes"] > 0 for f in listed)
    for f in listed:
        ids = [json.loads(x)["id"] for x in (tmp_path / "s" / f["path"]).read_text().splitlines()]
        assert ids == list(range(f["first_index"], f["last_index"] + 1)) and len(ids) <= 4
    assert [f["last_index"] for f in publication.write_shards(spark.range(5).coalesce(1), str(tmp_path / "c"), "csv", 2, ("id",))][-1] == 4


def test_registered_attempts_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    for attempt in ("a1", "a2"):
        publication.write_registered(spark, spark.range(3), root, "r1", attempt)
    with pytest.raises(FileExistsError):
        publication.write_registered(spark, spark.range(3), root, "r1", "a1")
    rows = publication.read_registered(spark, root, "r1", "a2")
    assert rows.count() == 3
    assert "PartitionFilters: [isnotnull(run_id" in rows._jdf.queryExecution().toString()


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "m.json").write_text(json.dumps(bundle(tmp_path)))
    (tmp_path / "policy.json").write_text(json.dumps(POLICY))
    at = [str(tmp_path / "m.json"), str(tmp_path), str(tmp_path / "policy.json")]
    assert main(["admit", *at], spark) == 0
    assert main(["reconcile-transaction", *at, str(tmp_path / "txn")], spark) == 0
    row = publication.open_bundle(spark, str(tmp_path / "txn"))["transactions"].first()
    assert (row.status, row.authoritative_proof) == ("MATCHED", False)
    assert row.source_identities == [["LEDGER_JOURNAL", "led", "j1"], ["PROCESSOR_EVENT", "p", "e1"]]
    assert main(["finalize", *at, str(tmp_path / "log"), "--attempt", "a1"], spark) == 0
    assert main(["finalize", *at, str(tmp_path / "log"), "--attempt", "a1"], spark) == 0
    assert main(["verify", str(tmp_path / "log")], spark) == 0
    assert '"entries": 1' in capsys.readouterr().out
    assert main(["reconcile-transaction", *at, str(tmp_path / "txn")], spark) == 2
