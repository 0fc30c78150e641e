"""Golden and adversarial cases of the reconciliation operators."""

import pytest
from pyspark.sql import functions as F

from concordat.functions.columns import derived_id, outer_trim
from concordat.operators import admission, compare, policy, revisions, settlements, transactions

EVENT = "source_record_id string, processor string, merchant_id string, payment_id string, event_type string, amount_minor long, currency string, reference_event_id string"
JOURNAL = "journal_id string, processor string, merchant_id string, payment_id string, entry_type string, currency string, postings array<struct<line_id:string,account_role:string,side:string,amount_minor:long>>"
SETTLEMENT = "source_record_id string, processor string, merchant_id string, settlement_id string, settlement_cycle string, currency string, gross_minor long, fee_minor long, refund_minor long, chargeback_minor long, reserve_minor long, reported_net_minor long"
SET_JOURNAL = "journal_id string, processor string, merchant_id string, settlement_id string, settlement_cycle string, currency string, postings array<struct<line_id:string,account_role:string,side:string,amount_minor:long>>"
BANK = "bank_record_id string, bank_account_id string, merchant_id string, settlement_reference string, direction string, currency string, amount_minor long"


def postings(side, amount, role="MERCHANT_PAYABLE"):
    return [("l1", "PROCESSOR_CLEARING", side, amount), ("l2", role, "CREDIT" if side == "DEBIT" else "DEBIT", amount)]


def event(i, kind="CAPTURE", amount=100, ref=None, merchant="m", payment="pay", currency="INR"):
    return (i, "p", merchant, payment, kind, amount, currency, ref)


def journal(i, kind="CAPTURE", amount=100, role="MERCHANT_PAYABLE", side=None, payment="pay"):
    return (i, "p", "m", payment, kind, "INR", postings(side or ("DEBIT" if kind == "CAPTURE" else "CREDIT"), amount, role))


def limits(transaction=None, settlement=None):
    return policy.Policy("v1", "x", transaction or policy.DEFAULT.transaction_tolerance, settlement or policy.DEFAULT.settlement_tolerance)


def run(spark, events, journals, **kw):
    rows = transactions.reconcile(spark.createDataFrame(events, EVENT), spark.createDataFrame(journals, JOURNAL), **kw).collect()
    return {r.event_class: (r.status, r.reason_codes, r.processor_minor, r.ledger_minor) for r in rows}


def test_golden_keys(spark):
    row = spark.range(1).select(
        derived_id("txn:", {"processor": F.lit("processor-a"), "merchant_id": F.lit("merchant-1"), "payment_id": F.lit("payment-1"), "event_class": F.lit("CAPTURE"), "currency": F.lit("INR")}).alias("t"),
        derived_id("stl:", {"processor": F.lit("processor-a"), "merchant_id": F.lit("merchant-1"), "settlement_id": F.lit("settlement-1"), "settlement_cycle": F.lit("2026-09-01"), "currency": F.lit("INR")}).alias("s"),
    ).first()
    assert row.t == "txn:7f5185560995fb0a625c814367c1019e8c6742df35ec22cb650c54be9ae0e102"
    assert row.s == "stl:6f63aaa7cc45d45249420f1a0b427348f870c23ceb0faa3e3d24c38b315d779c"


@pytest.mark.parametrize(
    ("events", "journals", "kind", "expected"),
    [
        ([event("c")], [journal("j")], "CAPTURE", ("MATCHED", "", 100, 100)),
        ([event("c")], [], "CAPTURE", ("EXCEPTION", "MISSING_LEDGER_MOVEMENT", 100, 0)),
        ([], [journal("j")], "CAPTURE", ("EXCEPTION", "MISSING_PROCESSOR_ACTIVITY", 0, 100)),
        ([event("c")], [journal("j", role="BANK_CASH")], "CAPTURE", ("EXCEPTION", "INVALID_ACCOUNT_ROLE", 100, 100)),
        ([event("c")], [journal("j", side="CREDIT")], "CAPTURE", ("EXCEPTION", "INVALID_ACCOUNT_ROLE", 100, -100)),
        ([event("c")], [journal("j", amount=98)], "CAPTURE", ("EXCEPTION", "PROCESSOR_LEDGER_MISMATCH", 100, 98)),
        ([event("r", "REFUND", 25, "none")], [journal("j", "REFUND", 25)], "REFUND", ("EXCEPTION", "UNRESOLVED_REFERENCE", -25, -25)),
        ([event("c"), event("r", "REFUND", 60, "c"), event("b", "CHARGEBACK", 41, "c")], [journal("j", "REFUND", 60)], "REFUND", ("EXCEPTION", "OVER_APPLIED_REFERENCE", -60, -60)),
        ([event("c"), event("r", "REFUND", 100, "c")], [journal("j", "REFUND", 100)], "REFUND", ("MATCHED", "", -100, -100)),
        ([event("c", merchant="other"), event("r", "REFUND", 10, "c")], [journal("j", "REFUND", 10)], "REFUND", ("EXCEPTION", "UNRESOLVED_REFERENCE", -10, -10)),
    ],
)
def test_transaction_cases(spark, events, journals, kind, expected):
    assert run(spark, events, journals)[kind] == expected


def test_tolerance_and_missing_policy(spark):
    assert run(spark, [event("c")], [journal("j", amount=99)], policy=limits({"INR": 1}))["CAPTURE"][:2] == ("WITHIN_TOLERANCE", "TOLERATED_DIFFERENCE")
    with pytest.raises(Exception, match="POLICY_MISMATCH"):
        run(spark, [event("c")], [journal("j", amount=99)], policy=limits({"USD": 1}))


def test_settlement_cases(spark):
    permitted = spark.createDataFrame([("m", "INR", "bank-m-INR")], policy.ACCOUNTS)

    def three(gross, fee, refund, reported, ledger, side, bank):
        s = spark.createDataFrame([("r", "p", "m", "s", "c", "INR", gross, fee, refund, 0, 0, reported)], SETTLEMENT)
        j = spark.createDataFrame([("j", "p", "m", "s", "c", "INR", postings(side, ledger, "BANK_CASH"))] if ledger else [], SET_JOURNAL)
        b = spark.createDataFrame(bank, BANK)
        r = settlements.reconcile(s, j, settlements.allocate(b, settlements.targets(s, j), permitted)).first()
        return r.status, r.reason_codes

    entry = lambda i, amount, ref="s", account="bank-m-INR", direction="CREDIT": (i, account, "m", ref, direction, "INR", amount)
    assert three(100, 20, 0, 80, 80, "CREDIT", [entry("1", 50, "  s "), entry("2", 30)]) == ("MATCHED", "")
    assert three(100, 100, 0, 0, 0, "CREDIT", []) == ("MATCHED", "")
    assert three(50, 10, 70, -30, 30, "DEBIT", [entry("1", 30, direction="DEBIT")]) == ("MATCHED", "")
    assert three(100, 0, 0, 100, 99, "CREDIT", [entry("1", 100)]) == ("WITHIN_TOLERANCE", "TOLERATED_DIFFERENCE")
    assert three(100, 20, 0, 81, 80, "CREDIT", [entry("1", 80)]) == ("EXCEPTION", "SETTLEMENT_FORMULA_MISMATCH")
    assert three(100, 20, 0, 80, 80, "CREDIT", [entry("1", 80, "S")]) == ("EXCEPTION", "MISSING_BANK_SETTLEMENT")
    assert three(100, 20, 0, 80, 80, "CREDIT", [entry("1", 80), entry("1", 80)]) == ("EXCEPTION", "DUPLICATE_BANK_MOVEMENT")
    assert three(100, 20, 0, 80, 80, "CREDIT", [entry("1", 80, account="x")]) == ("EXCEPTION", "INVALID_BANK_ACCOUNT")


def test_allocation_dispositions(spark):
    targets = spark.createDataFrame([("p", "m", "s", "c", "INR")], "processor string, merchant_id string, settlement_id string, settlement_cycle string, currency string")
    rows = [("1", "a", "m", None, "CREDIT", "INR", 5), ("2", "a", "m", " ", "DEBIT", "INR", 5), ("3", "a", "m", "x", "CREDIT", "INR", 5), ("4", "bank-m-INR", "m", " s\t", "CREDIT", "INR", 5)]
    got = {r.bank_record_id: (r.disposition, r.signed_minor) for r in settlements.allocate(spark.createDataFrame(rows, BANK), targets, spark.createDataFrame([("m", "INR", "bank-m-INR")], policy.ACCOUNTS)).collect()}
    assert got == {"1": ("UNALLOCATED_MISSING_REFERENCE", 5), "2": ("UNALLOCATED_MISSING_REFERENCE", -5), "3": ("UNALLOCATED_UNKNOWN_REFERENCE", 5), "4": ("ALLOCATED", 5)}


def test_journal_rules_and_admission(spark):
    bad = [("ok", *journal("j")[1:]), ("one", "p", "m", "x", "CAPTURE", "INR", [("l1", "PROCESSOR_CLEARING", "DEBIT", 5)]), ("unbalanced", "p", "m", "x", "CAPTURE", "INR", [("a", "PROCESSOR_CLEARING", "DEBIT", 5), ("a", "MERCHANT_PAYABLE", "CREDIT", 4)])]
    got = {r.journal_id: r.broken for r in admission.journal_violations(spark.createDataFrame(bad, JOURNAL)).collect()}
    assert got == {"one": "TOO_FEW_POSTINGS|UNBALANCED", "unbalanced": "REPEATED_LINE|UNBALANCED"}
    found = admission.required(spark.createDataFrame([event("a", merchant=None)], EVENT), "processor_event", "source_record_id", ("merchant_id", "payment_id"))
    with pytest.raises(ValueError, match="REQUIRED_FIELD"):
        admission.admit(found)


def test_overflow_is_rejected(spark):
    with pytest.raises(Exception, match="OVERFLOW|out of range|overflow"):
        run(spark, [event("a", amount=2**63 - 1), event("b", amount=1)], [])


def test_case_resolution_keeps_prior_reasons(spark):
    schema = "reconciliation_key string, status string, reason_codes string, difference_minor long"
    first = revisions.proofs(spark.createDataFrame([("k", "EXCEPTION", "MISSING_LEDGER_MOVEMENT", 5), ("o", "MATCHED", "", 0)], schema), "m1", "p", "TRANSACTION")
    second = revisions.proofs(spark.createDataFrame([("k", "MATCHED", "", 0), ("o", "EXCEPTION", "X", 1)], schema), "m2", "p", "TRANSACTION", first)
    opened = revisions.cases(first)
    third = revisions.cases(revisions.proofs(spark.createDataFrame([("k", "MATCHED", "", 0), ("o", "MATCHED", "", 0)], schema), "m3", "p", "TRANSACTION", second), revisions.cases(second, opened), second.where("reconciliation_key = 'o'"))
    got = {r.reconciliation_key: (r.case_status, r.reason_codes, r.case_revision) for r in revisions.cases(second, opened).collect()}
    assert got == {"k": ("RESOLVED_BY_LATE_DATA", "MISSING_LEDGER_MOVEMENT", 2), "o": ("OPEN", "X", 1)}
    assert {r.reconciliation_key: (r.case_status, r.case_revision) for r in third.collect()} == {"k": ("RESOLVED_BY_LATE_DATA", 3), "o": ("RESOLVED_BY_CORRECTION", 2)}
    assert revisions.proof_faults(first, None).isEmpty() and revisions.proof_faults(second, first).isEmpty()
    assert {r.fault for r in revisions.proof_faults(second.where("reconciliation_key = 'k'").withColumn("revision", F.lit(7)), first).collect()} == {"PROOF_ID", "BROKEN_CHAIN", "VANISHED"}


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(200).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b"))
    one, two = (compare.fingerprint(x, ("a", "b")).first() for x in (df, df.orderBy(F.rand(3)).repartition(7)))
    assert one == two
    assert compare.differences(df, df.where("a <> 5")).count() == 1


def test_trim_is_unicode(spark):
    assert spark.range(1).select(outer_trim(F.lit("　 x y \t"))).first()[0] == "x y"
