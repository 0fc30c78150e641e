"""A whole run: admission, carried state, results, proofs and cases, as frames to publish."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators import correction, results, revisions, settlements, state, transactions
from concordat.operators.policy import Policy

STATE = "state-"
PRIOR_TABLES = ("proofs", "cases", "lineage")


def reconciled(records: Mapping[str, DataFrame], policy: Policy, permitted: DataFrame, which: str = "all") -> dict[str, DataFrame]:
    """Flat results and the lineage of admitted records; settlement journals are those that name a settlement."""
    events, sets, journals, bank = (records[f] for f in ("PROCESSOR_EVENTS", "PROCESSOR_SETTLEMENTS", "LEDGER_JOURNALS", "BANK_ENTRIES"))
    out = {}
    if which in ("transaction", "all"):
        own = journals.where(F.col("entry_type").isin(*transactions.ENTRY_TYPES))
        out["transactions"] = transactions.reconcile(events, own, policy)
        out["transaction-lineage"] = results.by_key(transactions.sources(events, own))
    if which in ("settlement", "all"):
        own = journals.where(F.col("entry_type").isin(*settlements.ENTRY_TYPES))
        allocations = settlements.allocate(bank, settlements.targets(sets, own), permitted)
        out["settlements"] = settlements.reconcile(sets, own, allocations, policy)
        out["settlement-lineage"] = settlements.sources(sets, own, allocations)
        out["bank-allocations"] = settlements.published(allocations)
    return out


def published(found: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Result tables in their published, nested shape."""
    out = {}
    for family, lineage in (("transactions", "transaction-lineage"), ("settlements", "settlement-lineage")):
        if family in found:
            out[family] = results.packed(found[family], found[lineage], family)
    if "bank-allocations" in found:
        out["bank-allocations"] = found["bank-allocations"]
    return out


def run(
    spark: SparkSession, observed: Mapping[str, DataFrame], policy: Policy, manifest_sha256: str,
    prior: Mapping[str, DataFrame] | None = None, document: Mapping[str, Any] | None = None, prior_policy: Policy | None = None,
) -> dict[str, DataFrame]:
    """All tables of the bundle that follows prior: results, proofs, cases, lineage and state.

    observed: admitted families. document: a correction, which needs the policy of the run before.
    """
    stored = {k.removeprefix(STATE).replace("-", "_").upper(): v for k, v in prior.items() if k.startswith(STATE)} if prior else None
    after = state.carried(stored, observed)
    records = after | {"BANK_ENTRIES": state.occurrences(after["BANK_ENTRIES"], observed["BANK_ENTRIES"])}
    permitted = policy.permitted(spark)
    found = reconciled(records, policy, permitted)
    both = {"TRANSACTION": found["transactions"], "SETTLEMENT": found["settlements"]}
    heads, lineage = (prior["proofs"], prior["lineage"]) if prior else (None, None)
    now_lineage = found["transaction-lineage"].unionByName(found["settlement-lineage"]).distinct()
    proofs = None
    for grain, rows in both.items():
        own = revisions.proofs(rows, manifest_sha256, policy.sha256, grain, heads)
        proofs = own if proofs is None else proofs.unionByName(own)
    corrected = None
    if document is not None:
        if prior is None:
            raise ValueError(f"{correction.RULE}: nothing to correct")
        items, sources = correction.tables(spark, correction.read_correction(document, policy, manifest_sha256))
        then = reconciled(records, prior_policy or policy, (prior_policy or policy).permitted(spark))
        results_of = lambda tables: tables["transactions"].select("reconciliation_key", "status", "difference_minor").unionByName(tables["settlements"].select("reconciliation_key", "status", "difference_minor"))
        correction.accept(items, sources, heads, prior["cases"], lineage, now_lineage, records["LEDGER_JOURNALS"], results_of(found), results_of(then))
        corrected = items
    case_heads = revisions.cases(proofs, prior["cases"] if prior else None, corrected)
    tables = published(found) | {"proofs": proofs, "cases": case_heads, "lineage": now_lineage}
    return tables | {STATE + family.lower().replace("_", "-"): df for family, df in after.items()}
