"""Proof and case revisions: history is appended, never rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions.columns import derived_id

OPEN, LATE, CORRECTED = "OPEN", "RESOLVED_BY_LATE_DATA", "RESOLVED_BY_CORRECTION"


def proof_id(grain: Column | str, revision: Column | str, manifest: Column | str, policy: Column | str) -> Column:
    return derived_id("prf:", {"grain": grain, "reconciliation_key": "reconciliation_key", "revision": revision, "manifest_sha256": manifest, "policy_sha256": policy})


def proofs(candidates: DataFrame, manifest: str, policy: str, grain: str, heads: DataFrame | None = None) -> DataFrame:
    """reconciliation_key, revision, proof_id, prior_proof_id, status, reason_codes, difference_minor of a run's
    candidates; each continues the key's head (revision, proof_id), if it has one."""
    now = candidates.select("reconciliation_key", "status", "reason_codes", "difference_minor")
    if heads is None:
        now = now.withColumn("prior_proof_id", F.lit(None).cast("string")).withColumn("revision", F.lit(1))
    else:
        last = heads.select("reconciliation_key", F.col("proof_id").alias("prior_proof_id"), F.col("revision").alias("last"))
        now = now.join(last, "reconciliation_key", "left").withColumn("revision", (F.coalesce("last", F.lit(0)) + 1).cast("int"))
    ident = proof_id(F.lit(grain), F.col("revision"), F.lit(manifest), F.lit(policy))
    named = now.withColumn("proof_id", ident)
    return named.select("reconciliation_key", F.lit(grain).alias("grain"), "revision", "proof_id", "prior_proof_id", F.lit(manifest).alias("manifest_sha256"), F.lit(policy).alias("policy_sha256"), "status", "reason_codes", "difference_minor")


def proof_faults(now: DataFrame, before: DataFrame | None) -> DataFrame:
    """Proofs whose id isn't derived from their fields, that don't continue the head before, or heads that vanished."""
    wrong = F.col("proof_id") != proof_id("grain", "revision", "manifest_sha256", "policy_sha256")
    names = ("reconciliation_key", "fault")
    found = now.where(wrong).select("reconciliation_key", F.lit("PROOF_ID").alias("fault"))
    if before is None:
        return found.unionByName(now.where("revision <> 1 OR prior_proof_id IS NOT NULL").select("reconciliation_key", F.lit("FIRST_REVISION").alias("fault")))
    last = before.select("reconciliation_key", F.col("proof_id").alias("last_id"), F.col("revision").alias("last"))
    both = now.select("reconciliation_key", "revision", "prior_proof_id", "proof_id").join(last, "reconciliation_key", "full_outer")
    fault = F.when(F.col("proof_id").isNull(), "VANISHED").when((F.col("revision") != F.coalesce("last", F.lit(0)) + 1) | ~F.col("prior_proof_id").eqNullSafe(F.col("last_id")), "BROKEN_CHAIN")
    return found.unionByName(both.select("reconciliation_key", fault.alias("fault")).where("fault IS NOT NULL").select(*names))


def chain(history: DataFrame) -> DataFrame:
    """Numbers a key's proofs from 1 and links each to the one before."""
    order = Window.partitionBy("reconciliation_key").orderBy("revision")
    return history.withColumn("position", F.row_number().over(order)).withColumn("predecessor_id", F.lag("proof_id").over(order))


def heads(history: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """The latest proof of each key: one aggregate. within: columns that the key determines; rows that are dealt by these stay where they are."""
    return history.groupBy(*within, "reconciliation_key").agg(F.max_by(F.struct("revision", "proof_id", "status", "reason_codes"), "revision").alias("h")).select("reconciliation_key", "h.*")


def case_id() -> Column:
    """A case's id, from the columns of its row."""
    return derived_id("case:", {c: c for c in ("grain", "reconciliation_key", "initial_exception_proof_id")})


CASE = "reconciliation_key string, grain string, case_id string, initial_exception_proof_id string, case_revision int, case_status string, reason_codes string, proof_id string"


def cases(now: DataFrame, before: DataFrame | None = None, corrected: DataFrame | None = None) -> DataFrame:
    """Case heads after a run: a key's case opens with its first exception; each later run adds a revision,
    open while the key is an exception, else resolved with the reasons it had. corrected: keys whose
    correction was accepted."""
    rows = now.select("reconciliation_key", "grain", "proof_id", "status", "reason_codes")
    if before is None:
        rows = rows.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("initial", "string"), ("last", "int"), ("reasons", "string"))))
    else:
        prior = before.select("reconciliation_key", F.col("initial_exception_proof_id").alias("initial"), F.col("case_revision").alias("last"), F.col("reason_codes").alias("reasons"))
        rows = rows.join(prior, "reconciliation_key", "left")
    mended = F.lit(False)
    if corrected is not None:
        rows = rows.join(corrected.select("reconciliation_key", F.lit(True).alias("mended")).distinct(), "reconciliation_key", "left")
        mended = F.coalesce("mended", F.lit(False))
    open_now = F.col("status") == "EXCEPTION"
    kept = rows.where(F.col("initial").isNotNull() | open_now).withColumn("initial_exception_proof_id", F.coalesce("initial", "proof_id"))
    return kept.select(
        "reconciliation_key", "grain", case_id().alias("case_id"), "initial_exception_proof_id", (F.coalesce("last", F.lit(0)) + 1).cast("int").alias("case_revision"),
        F.when(open_now, OPEN).when(mended, CORRECTED).otherwise(LATE).alias("case_status"),
        F.when(open_now, F.col("reason_codes")).otherwise(F.col("reasons")).alias("reason_codes"), "proof_id",
    )
