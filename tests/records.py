"""Source records with their digests, and bundles of them on disk."""

import csv
import hashlib
import io
import json

from concordat.operators.policy import canonical_digest
from concordat.sources import files

MOMENT = "2026-09-01T00:00:00Z"
TRANSPORT = ("payload_sha256", "received_at", "source_batch_id")


def signed(record):
    """record with the digest of its business fields; nulls are no members."""
    own = {k: v for k, v in record.items() if k not in TRANSPORT and v is not None}
    raw = json.dumps(own, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return record | {"payload_sha256": hashlib.sha256(raw.encode()).hexdigest()}


def event(i="e1", kind="CAPTURE", amount=100, reference=None, payment="pay", currency="INR", **changed):
    return signed({"schema_version": "2.0", "source_record_id": i, "source_batch_id": "b", "processor": "p", "merchant_id": "m", "payment_id": payment, "event_type": kind, "amount_minor": amount,
                   "currency": currency, "occurred_at": MOMENT, "received_at": MOMENT, "reference_event_id": reference} | changed)


def journal(i="j1", kind="CAPTURE", debit=100, credit=None, payment="pay", settlement=None, role="MERCHANT_PAYABLE", clearing="DEBIT", **changed):
    lines = [("l1", "PROCESSOR_CLEARING", clearing, debit), ("l2", role, "CREDIT" if clearing == "DEBIT" else "DEBIT", debit if credit is None else credit)]
    return signed({"schema_version": "2.0", "journal_id": i, "source_batch_id": "b", "ledger_system": "led", "processor": "p", "merchant_id": "m", "payment_id": None if settlement else payment, "settlement_id": settlement,
                   "settlement_cycle": "c1" if settlement else None, "entry_type": "SETTLEMENT" if settlement else kind, "currency": "INR", "effective_at": MOMENT, "received_at": MOMENT,
                   "postings": [dict(zip(("line_id", "account_role", "side", "amount_minor"), x, strict=True)) for x in lines]} | changed)


def settlement(i="s1", settlement="set", gross=100, fee=1, **changed):
    return signed({"schema_version": "2.0", "source_record_id": i, "source_batch_id": "b", "processor": "p", "merchant_id": "m", "settlement_id": settlement, "settlement_cycle": "c1", "currency": "INR", "gross_minor": gross,
                   "fee_minor": fee, "refund_minor": 0, "chargeback_minor": 0, "reserve_minor": 0, "reported_net_minor": gross - fee, "occurred_at": MOMENT, "received_at": MOMENT} | changed)


def bank(i="k1", account="acct-77", reference="set", amount=99, **changed):
    return signed({"schema_version": "2.0", "bank_record_id": i, "source_batch_id": "b", "bank_account_id": account, "merchant_id": "m", "settlement_reference": reference, "direction": "CREDIT", "amount_minor": amount,
                   "currency": "INR", "value_at": MOMENT, "received_at": MOMENT} | changed)


def policy(accounts=("acct-77",), tolerance=0, version="v1", **changed):
    rules = {c: {"exponent": 2, "transaction_tolerance_minor": tolerance, "settlement_tolerance_minor": 1} for c in ("INR", "JPY", "USD")}
    document = {
        "schema_version": "2.0", "policy_version": version, "currency_rules": rules, "late_data_strategy": "NEW_IMMUTABLE_REVISION",
        "transaction_rules": {"event_signs": {"CAPTURE": 1, "REFUND": -1, "CHARGEBACK": -1, "REVERSAL": -1}, "ledger_role": "PROCESSOR_CLEARING", "ledger_side_signs": {"DEBIT": 1, "CREDIT": -1}, "allowed_counterpart_roles": ["MERCHANT_PAYABLE"]},
        "settlement_rules": {
            "formula": "gross_minor-fee_minor-refund_minor-chargeback_minor-reserve_minor", "ledger_role": "PROCESSOR_CLEARING", "ledger_side_signs": {"DEBIT": -1, "CREDIT": 1}, "bank_side_signs": {"CREDIT": 1, "DEBIT": -1},
            "permitted_bank_accounts": [{"merchant_id": "m", "currency": "INR", "bank_account_ids": list(accounts)}],
        },
    } | changed
    return document | {"policy_sha256": canonical_digest(document, "policy_sha256")}


def text_of(family, records):
    if files.FAMILIES[family][0] == "json":
        return "".join(json.dumps({k: v for k, v in r.items() if v is not None}, ensure_ascii=False) + "\n" for r in records) or "\n"
    names = [c.split()[0] for c in files.FAMILIES[family][1].split(",")]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(names)
    writer.writerows([["" if r[n] is None else r[n] for n in names] for r in records])
    return out.getvalue()


def bundle(folder, policy_document, events=(), journals=(), settlements=(), banks=(), run="r1", texts=None):
    """Write the objects and return their manifest."""
    folder.mkdir(parents=True, exist_ok=True)
    families = {"PROCESSOR_EVENTS": events, "LEDGER_JOURNALS": journals, "PROCESSOR_SETTLEMENTS": settlements, "BANK_ENTRIES": banks}
    objects = []
    for family, records in families.items():
        text = (texts or {}).get(family, text_of(family, records))
        raw = text if isinstance(text, bytes) else text.encode()
        (folder / family).write_bytes(raw)
        n = raw.count(b"\n") - (files.FAMILIES[family][0] == "csv")
        objects.append({"family": family, "locator_type": "LOCAL_FILE", "relative_path": family, "size_bytes": len(raw), "sha256": hashlib.sha256(raw).hexdigest(), "record_count": 0 if raw == b"\n" else n})
    return bound({"run_id": run, "policy_version": policy_document["policy_version"], "policy_sha256": policy_document["policy_sha256"], "objects": objects})


def bound(manifest):
    return manifest | {"manifest_sha256": canonical_digest(manifest, "manifest_sha256")}
