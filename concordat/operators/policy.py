"""The reconciliation policy: one small document, checked on the driver, and its tables as DataFrames.

Document fields: policy_version, currency_rules (currency to transaction_tolerance_minor and
settlement_tolerance_minor), transaction_rules (event_signs, ledger_role, ledger_side_signs,
allowed_counterpart_roles), settlement_rules (formula, ledger_role, ledger_side_signs,
bank_side_signs, allowed_counterpart_roles if given, permitted_bank_accounts), late_data_strategy,
policy_sha256 over all other fields.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

MISMATCH = "POLICY_MISMATCH"
# What every policy must say, because the plans compute exactly this.
EVENT_SIGNS = {"CAPTURE": 1, "REFUND": -1, "CHARGEBACK": -1, "REVERSAL": -1}
CLEARING = "PROCESSOR_CLEARING"
TRANSACTION_SIDES = {"DEBIT": 1, "CREDIT": -1}
SETTLEMENT_SIDES = {"DEBIT": -1, "CREDIT": 1}
BANK_SIDES = {"CREDIT": 1, "DEBIT": -1}
FORMULA = "gross_minor-fee_minor-refund_minor-chargeback_minor-reserve_minor"
LATE_DATA = "NEW_IMMUTABLE_REVISION"
ACCOUNTS = "merchant_id string, currency string, bank_account_id string"


@dataclass(frozen=True)
class Policy:
    version: str
    sha256: str
    transaction_tolerance: Mapping[str, int]
    settlement_tolerance: Mapping[str, int]
    transaction_counterparts: tuple[str, ...] = ("MERCHANT_PAYABLE",)
    settlement_counterparts: tuple[str, ...] = ("BANK_CASH",)
    accounts: tuple[tuple[str, str, str], ...] = ()

    @property
    def currencies(self) -> tuple[str, ...]:
        return tuple(sorted(self.transaction_tolerance))

    def permitted(self, spark: SparkSession) -> DataFrame:
        """merchant_id, currency, bank_account_id of every permitted account."""
        return spark.createDataFrame(list(self.accounts), ACCOUNTS)


#: Tolerances and roles of the registered queries, whose permitted accounts are a table.
DEFAULT = Policy("v1", "policy", {"INR": 0, "JPY": 0, "USD": 0}, {"INR": 1, "JPY": 1, "USD": 1})


def canonical_digest(document: Mapping[str, Any], without: str) -> str:
    """SHA-256 of a document's canonical JSON without one field."""
    rest = {k: v for k, v in document.items() if k != without}
    return hashlib.sha256(json.dumps(rest, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def _need(test: bool, why: str) -> None:
    if not test:
        raise ValueError(f"{MISMATCH}: {why}")


def read_policy(document: Mapping[str, Any], known: Mapping[str, str] | None = None) -> Policy:
    """The checked policy. Refused: a wrong digest, a version known with another digest, rules that
    the plans don't compute, negative or missing tolerances, two rows of accounts for one merchant and currency."""
    digest = canonical_digest(document, "policy_sha256")
    version = document.get("policy_version")
    _need(document.get("policy_sha256") == digest, "the digest differs")
    _need(isinstance(version, str) and bool(re.fullmatch("v[1-9][0-9]*", version)), "no version")
    _need((known or {}).get(version, digest) == digest, "the version is known with another digest")
    _need(document.get("late_data_strategy", LATE_DATA) == LATE_DATA, "unknown late data strategy")
    events, sets = document["transaction_rules"], document["settlement_rules"]
    for rules, field, fixed in (
        (events, "event_signs", EVENT_SIGNS), (events, "ledger_role", CLEARING), (events, "ledger_side_signs", TRANSACTION_SIDES), (sets, "ledger_role", CLEARING),
        (sets, "ledger_side_signs", SETTLEMENT_SIDES), (sets, "bank_side_signs", BANK_SIDES), (sets, "formula", FORMULA),
    ):
        _need(rules.get(field) == fixed, f"{field} must be {fixed}")
    roles = tuple(events.get("allowed_counterpart_roles", ()))
    _need(bool(roles) and len(set(roles)) == len(roles) and CLEARING not in roles, "counterpart roles")
    limits = {name: {c: rule.get(f"{name}_tolerance_minor") for c, rule in document["currency_rules"].items()} for name in ("transaction", "settlement")}
    for own in limits.values():
        _need(bool(own) and all(isinstance(v, int) and not isinstance(v, bool) and 0 <= v < 1 << 63 for v in own.values()), "tolerances must be whole and not negative")
        _need(all(re.fullmatch("[A-Z]{3}", c) for c in own), "currency codes")
    rows = sets.get("permitted_bank_accounts", ())
    domains = [(r["merchant_id"], r["currency"]) for r in rows]
    _need(bool(rows) and len(set(domains)) == len(domains), "duplicate permitted-account domain")
    accounts = tuple((r["merchant_id"], r["currency"], a) for r in rows for a in r["bank_account_ids"])
    _need(len(set(accounts)) == len(accounts), "repeated account")
    return Policy(version, digest, limits["transaction"], limits["settlement"], roles, tuple(sets.get("allowed_counterpart_roles", DEFAULT.settlement_counterparts)), accounts)


def check_manifest(manifest: Mapping[str, Any], policy: Policy, known: Mapping[str, str] | None = None) -> str:
    """The manifest's digest, after it was proved and bound to the policy; a run id isn't used twice."""
    digest = canonical_digest(manifest, "manifest_sha256")
    if manifest.get("manifest_sha256") != digest:
        raise ValueError("SOURCE_IDENTITY_MISMATCH: manifest digest differs")
    _need(manifest.get("policy_version") == policy.version and manifest.get("policy_sha256") == policy.sha256, "the manifest names another policy")
    if (known or {}).get(str(manifest.get("run_id")), digest) != digest:
        raise ValueError("SOURCE_IDENTITY_MISMATCH: run identifier reused")
    return digest
