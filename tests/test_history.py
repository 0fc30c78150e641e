"""Histories: ancestry, derivation of proofs and cases, and the physical check of bundles."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from concordat.operators import history, results, revisions
from concordat.sources import publication, verification


@pytest.fixture(autouse=True)
def interpreted(spark):
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_ancestry(spark):
    rng, links, want = random.Random(1), [], {}
    for tree in range(6):
        for i in range(30):
            me = f"t{tree}-{i}"
            prior = f"t{tree}-{rng.randrange(i)}" if i else ("gone" if tree == 0 else None)
            links.append((me, prior))
            depth = want[prior][1] + 1 if i else 1
            want[me] = (f"t{tree}-0", depth, "ORPHAN" if tree == 0 and i == 0 else None)
    links += [("c1", "c3"), ("c2", "c1"), ("c3", "c2"), ("below", "c2"), ("self", "self"), (None, "t1-0"), links[4]]
    want |= dict.fromkeys(("c1", "c2", "c3", "below", "self"), (None, None, "CYCLE"))
    frame = spark.createDataFrame(links, "id string, prior string")
    assert {r.id: (r.root, r.depth, r.fault) for r in history.ancestry(frame).collect()} == want
    assert history.ancestry(frame.limit(0)).isEmpty()


def test_ancestry_of_many_generations(spark):
    links = spark.range(1500).selectExpr("id", "CASE WHEN id > 0 THEN id - 1 END AS prior")
    assert sorted((r.id, r.root, r.depth, r.fault) for r in history.ancestry(links).collect()) == [(i, 0, i + 1, None) for i in range(1500)]


STATUS = "reconciliation_key string, status string, reason_codes string, difference_minor bigint"
RUNS = [
    [("txn:a", "EXCEPTION", "X", 5), ("txn:b", "MATCHED", "", 0)],
    [("txn:a", "EXCEPTION", "X|Y", 6), ("txn:b", "MATCHED", "", 0), ("stl:c", "EXCEPTION", "Z", 1)],
    [("txn:a", "MATCHED", "", 0), ("txn:b", "WITHIN_TOLERANCE", "TOLERATED_DIFFERENCE", 1), ("stl:c", "MATCHED", "", 0), ("txn:d", "MATCHED", "", 0)],
]


def chain(spark, corrected=()):
    """Tables of each run, as the engine makes them."""
    out, heads, cases = [], None, None
    for number, rows in enumerate(RUNS, 1):
        frame = spark.createDataFrame(rows, STATUS)
        proofs = revisions.proofs(frame, f"m{number}", "p", "TRANSACTION", heads)
        fixed = spark.createDataFrame([(k,) for n, k in corrected if n == number], "reconciliation_key string")
        cases = revisions.cases(proofs, cases, fixed)
        out.append({"proofs": proofs, "cases": cases, "rows": frame})
        heads = proofs
    return out


def stacked(tables, name):
    out = None
    for number, own in enumerate(tables, 1):
        frame = own[name].withColumn("run", F.lit(number))
        out = frame if out is None else out.unionByName(frame)
    return out


def faults(tables, changed=None, corrected=None):
    frames = {n: stacked(tables, n) for n in ("proofs", "rows", "cases")}
    frames |= {n: change(frames[n]) for n, change in (changed or {}).items()}
    return {(r.run, r.reconciliation_key, r.fault) for r in history.chain_faults(frames["proofs"], frames["rows"], frames["cases"], len(tables), corrected).collect()}


def test_every_fault_of_a_chain_is_found(spark):
    tables = chain(spark)
    at = lambda run, key: (F.col("run") == run) & (F.col("reconciliation_key") == key)
    put = lambda column, value, run, key: lambda df: df.withColumn(column, F.when(at(run, key), value).otherwise(F.col(column)))
    assert faults(tables) == set()
    assert faults(tables, {"rows": put("status", "EXCEPTION", 3, "txn:d")}) == {(3, "txn:d", "RESULT")}
    assert faults(tables, {"rows": lambda df: df.where(~at(2, "txn:b"))}) == {(2, "txn:b", "RESULT")}
    assert faults(tables, {"proofs": put("manifest_sha256", "m9", 2, "txn:b")}) == {(2, "txn:b", "PROOF_ID")}
    assert faults(tables, {"proofs": put("prior_proof_id", "prf:0", 3, "stl:c")}) == {(3, "stl:c", "BROKEN_CHAIN")}
    assert faults(tables, {"proofs": lambda df: df.where(~at(3, "txn:b"))}) == {(3, "txn:b", "VANISHED"), (3, "txn:b", "RESULT")}
    assert faults(tables, {"cases": put("case_status", "OPEN", 3, "txn:a")}) == {(3, "txn:a", "CASE")}
    assert faults(tables, {"cases": put("reason_codes", "X", 3, "txn:a")}) == {(3, "txn:a", "CASE")}
    assert faults(tables, {"cases": lambda df: df.where(~at(2, "stl:c"))}) == {(2, "stl:c", "CASE")}
    fixed = spark.createDataFrame([(3, "txn:a")], "run int, reconciliation_key string")
    assert faults(chain(spark, [(3, "txn:a")]), corrected=fixed) == set()
    assert faults(chain(spark, [(3, "txn:a")])) == {(3, "txn:a", "CASE")}


def test_faults_of_repeated_rows(spark):
    tables = chain(spark)
    twice = lambda df: df.unionByName(df.where("run = 2 AND reconciliation_key = 'txn:b'"))
    other = lambda df: df.unionByName(df.where("run = 2 AND reconciliation_key = 'txn:b'").withColumn("status", F.lit("EXCEPTION")))
    assert faults(tables, {"rows": twice}) == set()
    assert faults(tables, {"rows": other}) == {(2, "txn:b", "RESULT")}
    assert (2, "txn:b", "BROKEN_CHAIN") in faults(tables, {"proofs": twice})


def packed(rows, grain):
    own = rows.where(F.startswith("reconciliation_key", F.lit("txn:" if grain == "transactions" else "stl:")))
    codes = F.when(F.col("reason_codes") == "", F.array().cast("array<string>")).otherwise(F.split("reason_codes", r"\|"))
    return own.select("reconciliation_key", F.struct("difference_minor").alias("totals"), "status", codes.alias("reason_codes"))


def test_verify_derives_the_whole_log_again(spark, tmp_path):
    tables = chain(spark)

    def log(name, change=None):
        own, head = publication.History(spark, str(tmp_path / name)), None
        for number, run in enumerate(tables, 1):
            frames = {"proofs": run["proofs"], "cases": run["cases"], "transactions": packed(run["rows"], "transactions"), "settlements": packed(run["rows"], "settlements")}
            if change and number == 2:
                frames["transactions"] = frames["transactions"].withColumn("status", F.when(F.col("reconciliation_key") == "txn:b", "EXCEPTION").otherwise(F.col("status")))
            head = own.finalize(f"a{number}", frames, {"run_id": f"r{number}"}, head)["sha256"]
        return own

    assert log("good").verify() == 3
    # All digests of files, inventory, manifest and log are those of the changed bundle.
    with pytest.raises(ValueError, match="bundles/a2: RESULT of txn:b"):
        log("changed", True).verify()
    assert results.STATUSES[0] == "MATCHED"


def test_physical_faults(spark, tmp_path):
    place = tmp_path / "b"
    publication.write_bundle(spark, {"t": spark.range(40).repartition(5), "u": spark.range(3)}, str(place), {"run_id": "r"})
    declared = spark.read.parquet(f"{place}/inventory")
    assert declared.agg(F.sum("n_rows")).first()[0] == 43 and {r.columns for r in declared.collect()} == {"id int64"}
    parts = sorted((place / "t").glob("part-*.parquet"))
    for crc in place.rglob(".*.crc"):
        crc.unlink()
    shutil.copy(parts[0], place / "t/part-extra.parquet")
    parts[1].unlink()
    parts[2].write_bytes(parts[2].read_bytes()[:-3] + b"xxx")
    spark.range(2).select(F.col("id").cast("string").alias("id")).coalesce(1).write.parquet(str(tmp_path / "typed"))
    shutil.copy(next((tmp_path / "typed").glob("part-*.parquet")), parts[3])
    name = lambda p: f"t/{p.name}"
    now = verification.facts(spark, str(place)).where("path LIKE 't/%' OR path LIKE 'u/%'")
    found = {(r.path, r.fault) for r in verification.physical_faults(declared, now).collect()}
    same_size = parts[3].stat().st_size == declared.where(F.col("path") == name(parts[3])).first().size_bytes
    same_rows = declared.where(F.col("path") == name(parts[3])).first().n_rows == 2
    assert found == {
        ("t/part-extra.parquet", "EXTRA"), (name(parts[1]), "MISSING"), (name(parts[2]), "DIGEST"), (name(parts[2]), "ROWS"), (name(parts[2]), "COLUMNS"),
        (name(parts[3]), "DIGEST"), (name(parts[3]), "COLUMNS"), *([] if same_size else [(name(parts[3]), "SIZE")]), *([] if same_rows else [(name(parts[3]), "ROWS")]),
    }
    with pytest.raises(ValueError, match="files differ"):
        publication.open_bundle(spark, str(place))
    repeated = verification.physical_faults(declared.unionByName(declared.where("path LIKE 'u/%'")), declared)
    assert {r.fault for r in repeated.collect()} == {"REPEATED"}
