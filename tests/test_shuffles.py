"""How often queries over whole histories shuffle and read: once, whatever the result."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from concordat.functions.columns import canonical_timestamp
from concordat.operators import admission, digests
from concordat.operators import transactions as txn
from concordat.plans import audit, registry
from concordat.sources import derived

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
QUERIES = registry.QUERIES | audit.QUERIES


def shuffles(name, spark):
    """Exchanges by hash in the plan of the returned frame."""
    return QUERIES[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_histories_equal_runs_one_by_one(spark):
    seen = lambda df: df.withColumn("since", (df.day >= derived.FIRST_DAYS).cast("int") + 1)
    events, journals = derived.events(spark, str(FOLDER)), derived.journals(spark, str(FOLDER))
    found = txn.histories(seen(events), seen(journals), 2)
    names = ["run", "reconciliation_key", *txn.TOTALS, "status", "reason_codes"]
    want = registry._two_runs(spark, str(FOLDER)).select(names)
    assert sorted(map(tuple, found.select(names).collect())) == sorted(map(tuple, want.collect()))
    per = {}
    for r in found.select("reconciliation_key", "run", "revision").collect():
        per.setdefault(r.reconciliation_key, []).append((r.run, r.revision))
    assert all([n for _, n in sorted(runs)] == list(range(1, len(runs) + 1)) for runs in per.values())


def test_latest_heads_shuffles_records_once(spark):
    # Two sides of the references, and the contributions; heads stay where their key's runs were summed.
    assert shuffles("latest_heads", spark) <= 4


def test_case_transitions_shuffles_records_once(spark):
    assert shuffles("case_transitions", spark) <= 4


def test_chain_audit_meets_without_a_further_shuffle(spark):
    # Proofs, results and cases are three readings of one history: the contributions and a side or two of the references each.
    assert shuffles("chain_audit", spark) <= 9


def test_txn_packed_lists_sources_where_they_are_summed(spark):
    assert shuffles("txn_packed", spark) <= 3


def test_audited_results_are_reconciled_once(spark):
    for df in audit._audited(spark, str(FOLDER)):
        assert not any(t in f for f in df.inputFiles() for t in ("lineitem", "orders", "v_movement"))


def test_leaves_shuffle_digests_as_bytes(spark):
    leaf = digests.leaves(digests.placed(spark.range(10).withColumn("t", F.col("id") % 3), ("id",)), 2)
    keys = [line for line in leaf._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line or "Scan" in line]
    assert len(keys) > 1 and "unhex" in leaf._jdf.queryExecution().optimizedPlan().toString()
    assert leaf.schema["digest"].dataType.typeName() == "string" and {len(r.node) for r in leaf.collect()} == {2}


def test_replay_classes_meet_in_one_shuffle(spark):
    found = QUERIES["replay_classes"](spark, str(FOLDER))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert not any("lineitem" in f for f in found.inputFiles())


def test_occurrences_keep_no_texts_and_one_shuffle(spark):
    found = QUERIES["occurrence_inventory"](spark, str(FOLDER))
    shown = found._jdf.queryExecution().executedPlan().toString()
    assert shown.count("Exchange") == 1 and not any(c in shown for c in ("path#", "line#"))


def test_rules_are_computed_once_a_record(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    shown = QUERIES["admission_journals"](spark, str(FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert shown.count("sha2(") == 4  # the digest of each of three kinds of records, and the one that it must equal


def test_outer_blanks_and_moments(spark):
    texts = ["", " ", "a", " a", "a ", "a b", "a\n", "\na", "a ", " ", "a\u0085", " a", "ab\r\n", "한", "\U0001f600", "\U0001f600 ", None, "2020-01-01T00:00:00Z", "2020-13-01T00:00:00Z", "2020-01-01T00:00:00.5+00:00", "0001-01-01T00:00:00+14:00", "9999-12-31T23:59:59-14:00"]
    df = spark.createDataFrame([(t,) for t in texts], "schema_version string")
    every = ("source_batch_id", "source_record_id", "processor", "merchant_id", "settlement_id", "settlement_cycle", "currency", "received_at", "payload_sha256")
    rows = df.select("schema_version", F.col("schema_version").alias("occurred_at"), *(F.lit("x").alias(c) for c in every), *(F.lit(1).alias(c) for c in admission.NOT_NEGATIVE["PROCESSOR_SETTLEMENTS"]))
    rules = admission.row_rules(rows, "PROCESSOR_SETTLEMENTS", registry.DEFAULT)
    blank, moment = rules["SCHEMA_VIOLATION:schema_version is empty or has outer blanks"], rules["SCHEMA_VIOLATION:occurred_at is no moment"]
    text = F.col("schema_version")
    for r in rows.select(text.alias("t"), blank.alias("b"), text.rlike(r"(?U)^$|^\s|\s$").alias("was"), moment.alias("m"), (text.isNotNull() & canonical_timestamp(text).isNull()).alias("never")).collect():
        assert (r.b, r.m) == (r.was, r.never), repr(r.t)
