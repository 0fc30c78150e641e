"""Seeded properties of whole results: what a change of the records must change, and what it must leave alone."""

import random

import pytest

from concordat.operators import admission, state
from concordat.operators.policy import read_policy
from concordat.plans import engine
from concordat.sources import files
from tests import records
from tests.records import bank, event, journal, settlement

POLICY = read_policy(records.policy())
NAMES = {"PROCESSOR_EVENTS": "events", "LEDGER_JOURNALS": "journals", "PROCESSOR_SETTLEMENTS": "settlements", "BANK_ENTRIES": "banks"}
MERCHANTS = {"ma": "INR", "mb": "JPY", "mc": "USD", "md": "INR"}


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def base():
    """Four merchants with payments, refunds, journals, a settlement and its deposits in two pieces; all in balance."""
    rng, out = random.Random(730031), {n: [] for n in NAMES.values()}
    for m, c in MERCHANTS.items():
        own, gross, refunds = {"merchant_id": m, "currency": c}, 0, 0
        for i in range(4):
            amount, pay = rng.randint(100, 900), f"{m}-{i}"
            out["events"].append(event(f"c-{pay}", amount=amount, payment=pay, **own))
            out["journals"].append(journal(f"j-{pay}", debit=amount, payment=pay, **own))
            gross += amount
            if i % 2:
                back = rng.randint(1, amount)
                out["events"].append(event(f"r-{pay}", "REFUND", back, f"c-{pay}", payment=pay, **own))
                out["journals"].append(journal(f"k-{pay}", "REFUND", back, payment=pay, clearing="CREDIT", **own))
                refunds += back
        net = gross - 1 - refunds
        out["settlements"].append(settlement(f"s-{m}", f"set-{m}", gross, 1, refund_minor=refunds, reported_net_minor=net, **own))
        out["journals"].append(journal(f"l-{m}", debit=net, settlement=f"set-{m}", role="BANK_CASH", clearing="CREDIT", **own))
        piece = rng.randint(1, net - 1)
        out["banks"] += [bank(f"b{x}-{m}", f"acct-{m}", f"set-{m}", part, merchant_id=m, currency=c) for x, part in ((1, piece), (2, net - piece))]
    return out


def frames(spark, rows):
    return {f: spark.createDataFrame(rows[n], files.FAMILIES[f][1]) for f, n in NAMES.items()}


def found(spark, rows, n=1, policy=POLICY):
    """Results by (merchant, own key) as (status, reasons, difference)."""
    tables = {f: df.repartition(n) for f, df in frames(spark, rows).items()}
    ready = {f: df if f == "BANK_ENTRIES" else admission.replay_once(df, admission.IDENTITIES[f]) for f, df in tables.items()}
    permitted = spark.createDataFrame([(m, c, f"acct-{m}") for m, c in MERCHANTS.items()], "merchant_id string, currency string, bank_account_id string")
    out = engine.reconciled(ready, policy, permitted)
    got = {(r.merchant_id, r.payment_id, r.event_class): (r.status, r.reason_codes, r.difference_minor, r.processor_minor) for r in out["transactions"].collect()}
    return got | {(r.merchant_id, r.settlement_id): (r.status, r.reason_codes, r.difference_minor, r.bank_minor) for r in out["settlements"].collect()}


@pytest.fixture(scope="module")
def before(spark, base):
    got = found(spark, base)
    assert {v[0] for v in got.values()} == {"MATCHED"} and len(got) == 4 * 7
    return got


def changed(before, after):
    return {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}


def test_order_and_partitions(spark, base, before):
    rng = random.Random(1)
    assert found(spark, {n: rng.sample(rows, len(rows)) for n, rows in base.items()}, 4) == before


def test_replays_are_idempotent_and_conflicts_refused(spark, base, before):
    again = {n: rows + (rows[:3] if n != "banks" else []) for n, rows in base.items()}
    assert found(spark, again) == before
    other = records.signed(base["events"][0] | {"amount_minor": 1})
    rules = {r.rule for r in admission.gates(frames(spark, base | {"events": [*base["events"], other]}), POLICY).collect()}
    assert "IDENTITY_CONFLICT" in rules
    seen = state.classified(frames(spark, base)["PROCESSOR_EVENTS"], spark.createDataFrame([base["events"][1], other], files.FAMILIES["PROCESSOR_EVENTS"][1]), ("processor", "source_record_id"))
    assert sorted(r.replay_class for r in seen.collect()) == ["CONFLICT", "REPLAY"]


def test_merchants_and_currencies_are_isolated(spark, base, before):
    """Without one merchant's records the others' results are the same; each currency's totals are its own."""
    for gone in ("ma", "mc"):
        rest = found(spark, {n: [r for r in rows if r["merchant_id"] != gone] for n, rows in base.items()})
        assert rest == {k: v for k, v in before.items() if k[0] != gone}
    moved = [records.signed(r | {"merchant_id": "md"}) if r["payment_id"] == "ma-0" else r for r in base["events"]]
    assert changed(before, found(spark, base | {"events": moved})) == {("ma", "ma-0", "CAPTURE"), ("md", "ma-0", "CAPTURE")}
    mixed = [records.signed(r | {"currency": "USD"}) if r["source_record_id"] == "c-ma-0" else r for r in base["events"]]
    rules = [(r.rule, r.identity) for r in admission.gates(frames(spark, base | {"events": mixed}), POLICY).where("rule = 'CURRENCY_DOMAIN_VIOLATION'").collect()]
    assert rules == [("CURRENCY_DOMAIN_VIOLATION", "p/ma/ma-0/CAPTURE")]


def test_split_deposits_and_journals_add_up(spark, base, before):
    first, *rest = base["banks"]
    pieces = [records.signed(first | {"bank_record_id": f"x{i}", "amount_minor": a}) for i, a in enumerate((1, first["amount_minor"] - 1))]
    assert found(spark, base | {"banks": [*pieces, *rest]}) == before
    less = records.signed(first | {"amount_minor": first["amount_minor"] + 2})
    after = found(spark, base | {"banks": [less, *rest]})
    assert changed(before, after) == {("ma", "set-ma")} and after["ma", "set-ma"][:3] == ("EXCEPTION", "PROCESSOR_BANK_MISMATCH|LEDGER_BANK_MISMATCH", 2)


def test_missing_sources_name_their_side(spark, base, before):
    for name, gone, key, reason in (
        ("journals", "j-mb-0", ("mb", "mb-0", "CAPTURE"), "MISSING_LEDGER_MOVEMENT"), ("events", "r-mb-1", ("mb", "mb-1", "REFUND"), "MISSING_PROCESSOR_ACTIVITY"),
        ("settlements", "s-mb", ("mb", "set-mb"), "MISSING_PROCESSOR_ACTIVITY"), ("journals", "l-mb", ("mb", "set-mb"), "MISSING_LEDGER_MOVEMENT"),
    ):
        after = found(spark, base | {name: [r for r in base[name] if gone not in (r.get("source_record_id"), r.get("journal_id"))]})
        assert changed(before, after) == {key} and after[key][:2] == ("EXCEPTION", reason)


def test_references_can_not_exceed_their_capture(spark, base, before):
    capture = next(r for r in base["events"] if r["source_record_id"] == "c-mc-1")
    more = event("r2", "CHARGEBACK", capture["amount_minor"], "c-mc-1", payment="mc-1", merchant_id="mc", currency="USD")
    book = journal("k2", "CHARGEBACK", capture["amount_minor"], payment="mc-1", clearing="CREDIT", merchant_id="mc", currency="USD")
    after = found(spark, base | {"events": [*base["events"], more], "journals": [*base["journals"], book]})
    assert changed(before, after) == {("mc", "mc-1", "REFUND"), ("mc", "mc-1", "CHARGEBACK")}
    assert {after[k][:2] for k in changed(before, after)} == {("EXCEPTION", "OVER_APPLIED_REFERENCE")}


def test_settlement_formula(spark, base, before):
    wrong = [records.signed(r | {"reported_net_minor": r["reported_net_minor"] + 5}) if r["merchant_id"] == "md" else r for r in base["settlements"]]
    after = found(spark, base | {"settlements": wrong})
    assert changed(before, after) == {("md", "set-md")} and after["md", "set-md"][:3] == ("EXCEPTION", "SETTLEMENT_FORMULA_MISMATCH", 0)


def test_a_policy_change_is_no_source_change(spark, base, before):
    """Another tolerance changes verdicts of differing keys only, and no amounts."""
    off = [records.signed(r | {"amount_minor": r["amount_minor"] + 1}) if r["source_record_id"] == "c-ma-0" else r for r in base["events"]]
    strict, loose = (found(spark, base | {"events": off}, policy=p) for p in (POLICY, read_policy(records.policy(tolerance=1))))
    key = ("ma", "ma-0", "CAPTURE")
    assert changed(strict, loose) == {key} and (strict[key][:2], loose[key][:2]) == (("EXCEPTION", "PROCESSOR_LEDGER_MISMATCH"), ("WITHIN_TOLERANCE", "TOLERATED_DIFFERENCE"))
    assert strict[key][2:] == loose[key][2:] and changed(before, strict) == {key}
