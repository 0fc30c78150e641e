"""Published results: nested rows with their sources, and the rules that every row and summary must obey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.columns import derived_id, exact_amount, reasons
from concordat.operators import settlements as stl
from concordat.operators import transactions as txn

STATUSES = ("MATCHED", "WITHIN_TOLERANCE", "EXCEPTION")
SPECS = {"transactions": ("txn:", txn), "settlements": ("stl:", stl)}


def packed(rows: DataFrame, sources: DataFrame | None, family: str) -> DataFrame:
    """reconciliation_key, key_components, totals, status, reason_codes, source_identities (sorted, each once), authoritative_proof.

    A row lists all of its sources, because the published row does; they are one payment's or one
    settlement's records, and their sets are built partially before the shuffle. Without sources rows have source_identities themselves.
    """
    _, spec = SPECS[family]
    if sources is not None:
        listed = sources.groupBy("reconciliation_key").agg(F.array_sort(F.collect_set("source_identity")).alias("source_identities"))
        rows = rows.join(listed, "reconciliation_key", "left")
    return rows.select(
        "reconciliation_key", F.struct(*spec.KEYS).alias("key_components"), F.struct(*spec.TOTALS).alias("totals"), "status",
        F.when(F.col("reason_codes") == "", F.array().cast("array<string>")).otherwise(F.split("reason_codes", r"\|")).alias("reason_codes"),
        F.coalesce("source_identities", F.array().cast("array<array<string>>")).alias("source_identities"), F.lit(False).alias("authoritative_proof"),
    )


def by_key(sources: DataFrame) -> DataFrame:
    """Transaction sources with the derived key in place of its components."""
    return sources.select(derived_id("txn:", txn.KEYS).alias("reconciliation_key"), "source_identity")


def flat(rows: DataFrame) -> DataFrame:
    """Packed rows with plain columns and joined reasons."""
    return rows.select("reconciliation_key", "key_components.*", "totals.*", "status", F.array_join("reason_codes", "|").alias("reason_codes"))


def _codes(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, r"\|"))


def _shared_rules(allowed: tuple[str, ...], codes: Column) -> dict[str, Column]:
    known = F.array(*map(F.lit, (*allowed, "TOLERATED_DIFFERENCE")))
    return {"CURRENCY": ~F.col("currency").rlike("^[A-Z]{3}$"), "REASONS": (F.size(F.array_distinct(codes)) != F.size(codes)) | (F.size(F.array_except(codes, known)) > 0)}


def row_faults(rows: DataFrame, family: str) -> DataFrame:
    """Flat result rows that contradict themselves, with the rules they break, in one scan."""
    prefix, spec = SPECS[family]
    codes = _codes(F.col("reason_codes"))
    left, right = spec.TOTALS[:2]
    deltas = {"processor_ledger_delta_minor": F.col(left) - F.col(right)}
    if family == "settlements":
        deltas |= {"processor_bank_delta_minor": F.col(left) - F.col("bank_minor"), "ledger_bank_delta_minor": F.col(right) - F.col("bank_minor")}
    wrong = F.lit(False)
    for name, value in deltas.items():
        wrong = wrong | (F.col(name) != value)
    sizes = [F.abs(F.col(d)) for d in deltas]
    difference = F.col("difference_minor")
    tolerated = (difference > 0) & (F.col("reason_codes") == "TOLERATED_DIFFERENCE")
    tests = _shared_rules(spec.REASONS, codes) | {
        "STATUS": ~F.col("status").isin(*STATUSES),
        "DELTA": wrong,
        "DIFFERENCE": difference != (F.greatest(*sizes) if len(sizes) > 1 else sizes[0]),
        "COUNT": F.exists(F.array(*(F.col(c) for c in spec.TOTALS if c.endswith("_count"))), lambda c: c < 0),
        "STATUS_REASON": ((F.col("status") == "MATCHED") != ((difference == 0) & (F.size(codes) == 0))) | ((F.col("status") == "WITHIN_TOLERANCE") != tolerated),
        "KEY": F.col("reconciliation_key") != derived_id(prefix, spec.KEYS),
    }
    return rows.withColumn("faults", F.array_join(reasons(tests), "|")).where("faults <> ''").select("reconciliation_key", "faults")


def allocation_faults(rows: DataFrame) -> DataFrame:
    """Allocation rows that contradict themselves."""
    allocated = F.col("disposition") == "ALLOCATED"
    tests = _shared_rules(stl.REASONS, _codes(F.col("reason_codes"))) | {
        "DISPOSITION": ~F.col("disposition").isin(*stl.DISPOSITIONS),
        "TARGET": (allocated != F.col("settlement_reconciliation_key").isNotNull()) | F.coalesce(~F.col("settlement_reconciliation_key").rlike("^stl:[0-9a-f]{64}$"), F.lit(False)),
        "PERMISSION": allocated != F.col("account_permitted").isNotNull(),
    }
    return rows.withColumn("faults", F.array_join(reasons(tests), "|")).where("faults <> ''").select("bank_account_id", "bank_record_id", "faults")


def summary_faults(summary: DataFrame, group: str, allowed: tuple[str, ...], amounts: tuple[str, ...]) -> DataFrame:
    """Summary rows (currency, group, reason_codes, n_rows, amounts as text) that contradict themselves."""
    codes = _codes(F.col("reason_codes"))
    names = STATUSES if group == "status" else stl.DISPOSITIONS
    disagree = F.lit(False)
    if group == "status":
        disagree = ((F.col(group) == "MATCHED") & (F.size(codes) > 0)) | ((F.col(group) == "WITHIN_TOLERANCE") & (F.col("reason_codes") != "TOLERATED_DIFFERENCE"))
    tests = _shared_rules(allowed, codes) | {
        group.upper(): ~F.col(group).isin(*names), "STATUS_REASON": disagree,
        "AMOUNT": F.exists(F.array(*amounts), lambda a: exact_amount(a).isNull()),
        "COUNT": (F.col("n_rows") < 1) | F.exists(F.array(F.lit("0"), *(F.col(c) for c in amounts if c.endswith("_count"))), lambda a: exact_amount(a) < 0),
    }
    return summary.withColumn("faults", F.array_join(reasons(tests), "|")).where("faults <> ''").select("currency", group, "reason_codes", "faults")
