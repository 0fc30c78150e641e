"""Source corrections: added balanced journals that are declared to mend an open exception.

Document: kind BALANCED_JOURNAL_ADJUSTMENT, policy_sha256, manifest_sha256, items sorted by key
(reconciliation_key, prior_proof_id, initial_exception_proof_id, original_sources and
corrective_sources, each a sorted list of identity [ledger_system, journal_id] and sha256), and
correction_sha256 over all other fields. Accepted only if each item's case is open at that proof,
nothing stored was removed or changed, exactly the declared journals are new under the key, and the
difference shrinks under the policy before; if the case closes, it must close under that policy too.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators.admission import _row, admit, violations
from concordat.operators.policy import Policy, canonical_digest

KIND, RULE = "BALANCED_JOURNAL_ADJUSTMENT", "CORRECTION_REFUSED"
ITEM = "reconciliation_key string, prior_proof_id string, initial_exception_proof_id string"
SOURCE = "reconciliation_key string, part string, ledger_system string, journal_id string, sha256 string"


def read_correction(document: Mapping[str, Any], policy: Policy, manifest_sha256: str) -> Mapping[str, Any]:
    """The document, after its digest, bindings and order were checked."""

    def need(test: bool, why: str) -> None:
        if not test:
            raise ValueError(f"{RULE}: {why}")

    need(document.get("kind") == KIND, "unknown kind")
    need(document.get("correction_sha256") == canonical_digest(document, "correction_sha256"), "the digest differs")
    need(document.get("policy_sha256") == policy.sha256 and document.get("manifest_sha256") == manifest_sha256, "it is bound to another run")
    keys = [i["reconciliation_key"] for i in document["items"]]
    need(bool(keys) and keys == sorted(set(keys)), "keys must be sorted and unique")
    for item in document["items"]:
        for part in ("original_sources", "corrective_sources"):
            ids = [tuple(s["identity"]) for s in item[part]]
            need(ids == sorted(set(ids)), f"{part} must be sorted and unique")
        need(bool(item["corrective_sources"]), "no corrective source")
    return document


def tables(spark: SparkSession, document: Mapping[str, Any]) -> tuple[DataFrame, DataFrame]:
    """The items and their sources."""
    items = [(i["reconciliation_key"], i["prior_proof_id"], i["initial_exception_proof_id"]) for i in document["items"]]
    sources = [(i["reconciliation_key"], part, *s["identity"], s["sha256"]) for i in document["items"] for part in ("original", "corrective") for s in i[f"{part}_sources"]]
    return spark.createDataFrame(items, ITEM), spark.createDataFrame(sources, SOURCE)


def faults(
    items: DataFrame, sources: DataFrame, prior_proofs: DataFrame, prior_cases: DataFrame, prior_sources: DataFrame, now_sources: DataFrame,
    journals: DataFrame, now: DataFrame, under_prior_policy: DataFrame,
) -> DataFrame:
    """Violations of a correction. prior_sources and now_sources: (reconciliation_key, source_identity);
    journals: ledger_system, journal_id, payload_sha256 of the state after; now and under_prior_policy: results."""
    key = F.col("reconciliation_key")
    cases = prior_cases.select("reconciliation_key", "case_status", F.col("initial_exception_proof_id").alias("opened_by"))
    heads = prior_proofs.select("reconciliation_key", "proof_id", F.col("difference_minor").alias("difference_before"))
    after = now.select("reconciliation_key", F.col("status").alias("status_now"))
    effect = under_prior_policy.select("reconciliation_key", F.col("status").alias("status_then"), F.col("difference_minor").alias("difference_after"))
    named = items
    for other in (cases, heads, after, effect):
        named = named.join(other, "reconciliation_key", "left")
    tests = {
        "no open case": ~F.coalesce(F.col("case_status") == "OPEN", F.lit(False)),
        "another predecessor": ~(F.col("prior_proof_id").eqNullSafe(F.col("proof_id")) & F.col("initial_exception_proof_id").eqNullSafe(F.col("opened_by"))),
        "the difference does not shrink": ~F.coalesce(F.col("difference_after") < F.col("difference_before"), F.lit(False)),
        "the policy, not the source, resolves it": (F.col("status_now") != "EXCEPTION") & (F.col("status_then") == "EXCEPTION"),
    }
    wrong = named.select("reconciliation_key", F.explode(F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))).alias("why"))
    frames = [_row(wrong, RULE, "CORRECTION", key, F.col("why"))]
    held = journals.select("ledger_system", "journal_id", F.col("payload_sha256").alias("sha256"))
    unknown = sources.join(held, ["ledger_system", "journal_id", "sha256"], "left_anti")
    frames.append(_row(unknown, RULE, "CORRECTION", key, F.lit("a source is missing or differs")))
    # Declared and actual additions, both as (key, identity).
    declared = sources.where("part = 'corrective'").select("reconciliation_key", F.array(F.lit("LEDGER_JOURNAL"), "ledger_system", "journal_id").alias("source_identity"))
    of_items = lambda df: df.join(items.select("reconciliation_key"), "reconciliation_key", "left_semi").select("reconciliation_key", "source_identity").distinct()
    added = of_items(now_sources).join(of_items(prior_sources), ["reconciliation_key", "source_identity"], "left_anti")
    sides = declared.withColumn("d", F.lit(1)).unionByName(added.withColumn("d", F.lit(-1))).groupBy("reconciliation_key", "source_identity").agg(F.sum("d").alias("d")).where("d <> 0")
    frames.append(_row(sides, RULE, "CORRECTION", key, F.array_join("source_identity", "/")))
    originals = sources.where("part = 'original'").select("reconciliation_key", F.array(F.lit("LEDGER_JOURNAL"), "ledger_system", "journal_id").alias("source_identity"))
    frames.append(_row(originals.join(prior_sources, ["reconciliation_key", "source_identity"], "left_anti"), RULE, "CORRECTION", key, F.lit("an original source is not of this key")))
    return violations(*frames)


def accept(*args: DataFrame) -> None:
    """Refuse a correction with any violation."""
    admit(faults(*args))
