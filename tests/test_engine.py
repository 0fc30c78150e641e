"""Whole runs: admission gates, policy, carried state, late data, corrections."""

import itertools
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from concordat.operators import admission, correction, policy, results, settlements, state
from concordat.operators.policy import canonical_digest, read_policy
from concordat.plans import engine
from concordat.sources import files, publication
from tests import records
from tests.records import bank, event, journal, settlement

POLICY = records.policy()
COUNTER = itertools.count()


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """Many plans over a few rows each: compiling them would take most of the time."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def admit(spark, folder, document=POLICY, **families):
    own = folder / f"b{next(COUNTER)}"
    manifest = records.bundle(own, document, **families, run=own.name)
    return files.admit_bundle(spark, manifest, own, read_policy(document)), manifest["manifest_sha256"]


def run(spark, folder, prior=None, document=POLICY, correcting=None, **families):
    found, digest = admit(spark, folder, document, **families)
    place = str(folder / f"out{next(COUNTER)}")
    fixed = correcting(digest) if correcting else None
    publication.write_bundle(spark, engine.run(spark, found, read_policy(document), digest, prior, fixed), place, {"run_id": place})
    return publication.open_bundle(spark, place)


def statuses(tables, family="transactions"):
    return {(r.key_components.event_class if family == "transactions" else r.key_components.settlement_id): (r.status, r.reason_codes) for r in tables[family].collect()}


def cases(tables):
    return {r.grain: (r.case_status, r.case_revision, r.reason_codes) for r in tables["cases"].collect()}


def test_replays_count_once(spark, tmp_path):
    tables = run(spark, tmp_path, events=[event(), event()], journals=[journal(), journal()])
    row = tables["transactions"].first()
    assert (row.status, row.totals.processor_minor, row.totals.processor_record_count, row.totals.ledger_journal_count) == ("MATCHED", 100, 1, 1)


def frames(spark, **families):
    """Families as frames, without the way through files."""
    named = {"PROCESSOR_EVENTS": "events", "LEDGER_JOURNALS": "journals", "PROCESSOR_SETTLEMENTS": "settlements", "BANK_ENTRIES": "banks"}
    return {f: spark.createDataFrame(list(families.get(name, ())), files.FAMILIES[f][1]) for f, name in named.items()}


def test_gates_find_every_fault(spark, tmp_path):
    faulty = frames(
        spark,
        events=[
            event("fine", payment="f"), event("fine", payment="f"), event("twice", payment="a"), event("twice", amount=101, payment="a"), event("digest", payment="b") | {"amount_minor": 99}, event("null", merchant_id=None),
            event("noref", "REFUND", payment="c"), event("ref", reference="e0", payment="d"), event("zero", amount=0, payment="e"), event("eur", currency="EUR", payment="g"), event("when", occurred_at="yesterday", payment="h"),
            event("blank", payment="pay "), event("control", payment="p\x01y"), event("d1", payment="i"), event("d2", currency="USD", payment="i"), event("kind", "VOID", payment="j"),
        ],
        journals=[journal("sums", debit=100, credit=40, payment="k"), journal("keys", settlement_id="s", payment="l"), journal("ok", payment="m")],
        settlements=[settlement("s1"), settlement("s2", processor="q"), settlement("s3", "neg", fee_minor=-1)],
        banks=[bank("b1"), bank("b1"), bank("b2", direction="UP")],
    )
    found = admission.gates(faulty, read_policy(POLICY)).collect()
    got = {(r.rule, r.identity, r.detail) for r in found}
    schema = lambda i, detail: ("SCHEMA_VIOLATION", f"p/{i}", detail)
    assert got == {
        ("IDENTITY_CONFLICT", "p/twice", "2"), ("SOURCE_IDENTITY_MISMATCH", "p/digest", "payload digest"), schema("null", "merchant_id is null"), schema("noref", "reference"), schema("ref", "reference"),
        schema("zero", "amount_minor is not positive"), schema("eur", "unsupported currency"), schema("when", "occurred_at is no moment"), schema("blank", "payment_id is empty or has outer blanks"),
        schema("control", "payment_id holds control characters"), schema("kind", "unknown event_type"), schema("kind", "reference"), ("CURRENCY_DOMAIN_VIOLATION", "p/m/i/CAPTURE", "2"), ("UNBALANCED_JOURNAL", "led/sums", "UNBALANCED"),
        ("UNBALANCED_JOURNAL", "led/keys", "business key"), ("AMBIGUOUS_BANK_ALLOCATION", "m/INR/set", "2"), schema("s3", "fee_minor is negative"), ("SCHEMA_VIOLATION", "acct-77/b2", "unknown direction"),
    }
    with pytest.raises(ValueError, match="UNBALANCED_JOURNAL"):
        admit(spark, tmp_path, journals=[journal(debit=100, credit=40)])


def test_accounts_come_from_the_policy(spark, tmp_path):
    families = {"settlements": [settlement()], "journals": [journal("j", settlement="set", role="BANK_CASH", clearing="CREDIT", debit=99)], "banks": [bank()]}
    assert statuses(run(spark, tmp_path, **families), "settlements") == {"set": ("MATCHED", [])}
    assert statuses(run(spark, tmp_path, document=records.policy(("other",)), **families), "settlements") == {"set": ("EXCEPTION", ["INVALID_BANK_ACCOUNT"])}


@pytest.mark.parametrize(("changed", "why"), [
    ({"late_data_strategy": "OVERWRITE"}, "late data"),
    ({"policy_version": "one"}, "version"),
    ({"currency_rules": {"INR": {"transaction_tolerance_minor": -1, "settlement_tolerance_minor": 0}}}, "tolerances"),
    ({"settlement_rules": POLICY["settlement_rules"] | {"formula": "gross_minor"}}, "formula"),
    ({"settlement_rules": POLICY["settlement_rules"] | {"permitted_bank_accounts": POLICY["settlement_rules"]["permitted_bank_accounts"] * 2}}, "duplicate"),
    ({"transaction_rules": POLICY["transaction_rules"] | {"allowed_counterpart_roles": ["PROCESSOR_CLEARING"]}}, "roles"),
])
def test_policies_are_checked(changed, why):
    with pytest.raises(ValueError, match=why):
        read_policy(records.policy(**changed))


def test_policy_and_run_bindings():
    document = records.policy()
    with pytest.raises(ValueError, match="digest"):
        read_policy(document | {"policy_version": "v2"})
    with pytest.raises(ValueError, match="another digest"):
        read_policy(document, {"v1": "0"})
    own = read_policy(document)
    manifest = records.bound({"run_id": "r", "policy_version": "v1", "policy_sha256": own.sha256})
    assert policy.check_manifest(manifest, own, {"r": manifest["manifest_sha256"]})
    with pytest.raises(ValueError, match="reused"):
        policy.check_manifest(manifest, own, {"r": "0"})
    with pytest.raises(ValueError, match="another policy"):
        policy.check_manifest(records.bound({"run_id": "r", "policy_version": "v1", "policy_sha256": "0"}), own)


def test_late_capture_resolves_and_keeps_history(spark, tmp_path):
    refund = {"events": [event("r", "REFUND", 25, "c", payment="q")], "journals": [journal("jr", "REFUND", 25, payment="q", clearing="CREDIT")]}
    first = run(spark, tmp_path, **refund)
    assert statuses(first) == {"REFUND": ("EXCEPTION", ["UNRESOLVED_REFERENCE"])}
    second = run(spark, tmp_path, first, events=[event("c", payment="q")], journals=[journal("jc", payment="q")])
    assert statuses(second) == {"REFUND": ("MATCHED", []), "CAPTURE": ("MATCHED", [])}
    assert cases(second) == {"TRANSACTION": ("RESOLVED_BY_LATE_DATA", 2, "UNRESOLVED_REFERENCE")}
    assert sorted(r.revision for r in second["proofs"].collect()) == [1, 2]
    # A replay changes nothing but adds a revision; another payload of a stored identity is refused.
    third = run(spark, tmp_path, second, **refund)
    assert statuses(third) == statuses(second) and sorted(r.revision for r in third["proofs"].collect()) == [2, 3]
    with pytest.raises(ValueError, match="IDENTITY_CONFLICT"):
        run(spark, tmp_path, second, events=[event("c", amount=7, payment="q")])


def test_bank_before_settlement(spark, tmp_path):
    first = run(spark, tmp_path, banks=[bank(reference=" set ")])
    assert first["bank-allocations"].first().disposition == "UNALLOCATED_UNKNOWN_REFERENCE"
    second = run(spark, tmp_path, first, settlements=[settlement()], journals=[journal("j", settlement="set", role="BANK_CASH", clearing="CREDIT", debit=99)])
    assert statuses(second, "settlements") == {"set": ("MATCHED", [])}
    # Duplicates stay duplicates, also in runs whose bundle holds no bank entry.
    third = run(spark, tmp_path, second, banks=[bank(reference=" set "), bank(reference=" set ")])
    assert statuses(third, "settlements") == {"set": ("EXCEPTION", ["DUPLICATE_BANK_MOVEMENT"])}
    fourth = run(spark, tmp_path, third)
    assert statuses(fourth, "settlements") == {"set": ("EXCEPTION", ["DUPLICATE_BANK_MOVEMENT"])}
    row = fourth["bank-allocations"].first()
    assert (row.duplicate_current_bundle, row.reason_codes) == (False, "DUPLICATE_BANK_MOVEMENT")


def test_references_must_be_clear_in_the_merged_state(spark, tmp_path):
    first = run(spark, tmp_path, settlements=[settlement()], banks=[bank()])
    assert [r.disposition for r in first["bank-allocations"].collect()] == ["ALLOCATED"]
    # Each bundle is clear by itself; with what is stored, 'set' names two settlements.
    for late in ({"settlements": [settlement("s2", processor="q")]}, {"settlements": [settlement("s2", settlement_cycle="c2")]}, {"journals": [journal("j", settlement="set", role="BANK_CASH", clearing="CREDIT", debit=99, processor="q")]}):
        with pytest.raises(ValueError, match="AMBIGUOUS_BANK_ALLOCATION: BANK_ENTRIES m/INR/set 2"):
            run(spark, tmp_path, first, **late)
    # Another merchant, currency or reference is another target; the stored one's journal is the same.
    second = run(spark, tmp_path, first, settlements=[settlement("s2", merchant_id="n"), settlement("s3", currency="USD", settlement_cycle="c9"), settlement("s4", "other")], journals=[journal("j", settlement="set", role="BANK_CASH", clearing="CREDIT", debit=99)])
    assert [(r.disposition, r.signed_minor) for r in second["bank-allocations"].collect()] == [("ALLOCATED", 99)]


def test_allocation_never_multiplies(spark):
    own, found = read_policy(POLICY), frames(spark, settlements=[settlement(), settlement("s2", processor="q")], banks=[bank()])
    permitted, keys = own.permitted(spark), settlements.targets(found["PROCESSOR_SETTLEMENTS"], found["LEDGER_JOURNALS"])
    with pytest.raises(Exception, match="AMBIGUOUS_BANK_ALLOCATION: BANK_ENTRIES/m/INR/set"):
        settlements.allocate(found["BANK_ENTRIES"], keys, permitted).collect()
    again = keys.where("processor = 'p'")
    assert settlements.allocate(found["BANK_ENTRIES"], again.unionByName(again), permitted).count() == 1


def test_correction(spark, tmp_path):
    first = run(spark, tmp_path, events=[event()], journals=[journal(debit=60)])
    proof, case = first["proofs"].first(), first["cases"].first()
    added = journal("j2", debit=40)

    def document(digest, **changed):
        item = {
            "reconciliation_key": proof.reconciliation_key, "prior_proof_id": proof.proof_id, "initial_exception_proof_id": case.initial_exception_proof_id,
            "original_sources": [{"identity": ["led", "j1"], "sha256": journal(debit=60)["payload_sha256"]}], "corrective_sources": [{"identity": ["led", "j2"], "sha256": added["payload_sha256"]}],
        } | changed
        value = {"kind": "BALANCED_JOURNAL_ADJUSTMENT", "policy_sha256": POLICY["policy_sha256"], "manifest_sha256": digest, "items": [item]}
        return value | {"correction_sha256": canonical_digest(value, "correction_sha256")}

    second = run(spark, tmp_path, first, correcting=document, journals=[added])
    assert statuses(second) == {"CAPTURE": ("MATCHED", [])} and cases(second)["TRANSACTION"][0] == "RESOLVED_BY_CORRECTION"
    for why, families, changed in (
        ("another predecessor", {"journals": [added]}, {"prior_proof_id": "prf:0"}),
        ("j3", {"journals": [added, journal("j3", debit=1)]}, {}),
        ("missing or differs", {"journals": [added]}, {"original_sources": [{"identity": ["led", "j1"], "sha256": "0"}]}),
    ):
        with pytest.raises(ValueError, match=why):
            run(spark, tmp_path, first, correcting=lambda d, c=changed: document(d, **c), **families)
    with pytest.raises(ValueError, match="no open case"):
        run(spark, tmp_path, second, correcting=document, journals=[journal("j4", debit=1)])
    with pytest.raises(ValueError, match="digest"):
        correction.read_correction(document("m") | {"kind": correction.KIND, "correction_sha256": "0"}, read_policy(POLICY), "m")


def test_names_meet_in_normal_form(spark, tmp_path):
    composed = "café"
    found, _ = admit(spark, tmp_path, events=[event(payment=composed)], journals=[journal(payment=composed)], banks=[bank(reference=composed)])
    assert found["PROCESSOR_EVENTS"].first().payment_id == composed
    raw = {"BANK_ENTRIES": spark.createDataFrame([(unicodedata.normalize("NFD", composed),)], "settlement_reference string")}
    assert admission.normalised(raw["BANK_ENTRIES"]).first().settlement_reference == composed
    # Every text, those of postings too; amounts stay exact.
    apart = unicodedata.normalize("NFD", composed)
    nested = spark.createDataFrame([(apart, [(apart, 1 << 62)], None)], "note string, postings array<struct<line_id:string,amount_minor:bigint>>, other string")
    row = admission.normalised(nested).first()
    assert (row.note, row.postings[0].line_id, row.postings[0].amount_minor, row.other) == (composed, composed, 1 << 62, None)


def test_overflowing_keys_are_named(spark):
    rows = [("a", (1 << 63) - 1), ("a", 0), ("b", (1 << 63) - 1), ("b", 1), ("c", -(1 << 62)), ("c", -(1 << 62)), ("c", -1), ("d", None), (None, 5)]
    found = admission.overflows(spark.createDataFrame(rows, "k string, amount_minor bigint"), "BANK_ENTRIES", ("k",)).collect()
    assert {(r.rule, r.identity, r.detail) for r in found} == {("ARITHMETIC_OVERFLOW", "b", str(1 << 63)), ("ARITHMETIC_OVERFLOW", "c", str(-(1 << 63) - 1))}


def test_orders_and_partitions_do_not_matter(spark, tmp_path):
    """Properties of results: order-free, replay-free, additive in split journals and deposits."""
    rng = random.Random(5)
    events = [event(f"e{i}", amount=100 + i, payment=f"pay{i % 7}") for i in range(30)]
    events += [event(f"r{i}", "REFUND", 10 + i, f"e{i}", payment=f"pay{i % 7}") for i in range(20)]
    journals = [journal(f"j{i}", debit=100 + i, payment=f"pay{i % 7}") for i in range(30)]
    found, _ = admit(spark, tmp_path, events=events, journals=journals)
    again, _ = admit(spark, tmp_path, events=rng.sample(events * 2, len(events) * 2), journals=rng.sample(journals, len(journals)))
    own = read_policy(POLICY)
    one, two = (engine.reconciled({k: v.repartition(n) for k, v in f.items()}, own, own.permitted(spark), "transaction")["transactions"] for f, n in ((found, 2), (again, 5)))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert results.row_faults(one, "transactions").isEmpty()
    total = one.agg(F.sum("processor_minor")).first()[0]
    assert total == sum(100 + i for i in range(30)) - sum(10 + i for i in range(20))
    counts = admission.replay_counts(again["PROCESSOR_EVENTS"], admission.IDENTITIES["PROCESSOR_EVENTS"]).first()
    assert (counts.n_rows, counts.n_replayed) == (50, 0)
    assert state.missing_from(found["PROCESSOR_EVENTS"], again["PROCESSOR_EVENTS"], ("processor", "source_record_id")).isEmpty()


def test_no_python_functions_in_the_plans(spark, tmp_path):
    found, _ = admit(spark, tmp_path, events=[event()], journals=[journal()], settlements=[settlement()], banks=[bank()])
    own = read_policy(POLICY)
    for frame in engine.published(engine.reconciled(found, own, own.permitted(spark))).values():
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_sessions_are_guarded(spark):
    from concordat.session import guard

    guard(spark)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            guard(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
