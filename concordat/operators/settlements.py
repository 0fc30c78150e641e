"""Three-way reconciliation of processor settlements, ledger journals and bank entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.columns import MONEY, derived_id, joined, outer_trim, reasons
from concordat.operators.policy import CLEARING, DEFAULT, Policy
from concordat.operators.transactions import journal_movement, tolerance

# Key components, entry types, reason codes in their order and dispositions.
KEYS = ("processor", "merchant_id", "settlement_id", "settlement_cycle", "currency")
ENTRY_TYPES = ("SETTLEMENT", "FEE", "RESERVE")
REASONS = (
    "INVALID_ACCOUNT_ROLE", "MISSING_LEDGER_MOVEMENT", "MISSING_PROCESSOR_ACTIVITY", "MISSING_BANK_SETTLEMENT", "UNALLOCATED_BANK_MOVEMENT", "INVALID_BANK_ACCOUNT",
    "DUPLICATE_BANK_MOVEMENT", "SETTLEMENT_FORMULA_MISMATCH", "PROCESSOR_LEDGER_MISMATCH", "PROCESSOR_BANK_MISMATCH", "LEDGER_BANK_MISMATCH",
)
DISPOSITIONS = ("ALLOCATED", "UNALLOCATED_MISSING_REFERENCE", "UNALLOCATED_UNKNOWN_REFERENCE")
DELTAS = ("processor_ledger_delta_minor", "processor_bank_delta_minor", "ledger_bank_delta_minor")
TOTALS = ("processor_net_minor", "ledger_clearing_minor", "bank_minor", *DELTAS, "difference_minor", "processor_settlement_count", "ledger_journal_count", "allocated_bank_entry_count")


def net(settlements: DataFrame) -> DataFrame:
    """Adds net_minor and formula_mismatch, record by record."""
    value = F.col("gross_minor").cast(MONEY) - F.col("fee_minor") - F.col("refund_minor") - F.col("chargeback_minor") - F.col("reserve_minor")
    return settlements.withColumn("net_minor", value.cast("bigint")).withColumn("formula_mismatch", F.col("net_minor") != F.col("reported_net_minor"))


def named(settlements: DataFrame, journals: DataFrame) -> DataFrame:
    """The settlement key of every record of either side."""
    return settlements.select(*KEYS).unionByName(journals.select(*KEYS))


def targets(settlements: DataFrame, journals: DataFrame) -> DataFrame:
    """Every settlement key that either side names."""
    return named(settlements, journals).distinct()


def once(bank: DataFrame) -> DataFrame:
    """Each bank identity once, with how often it came and whether a bundle before held it twice.

    Admission has refused identities with more than one payload, so any row of one is the same.
    """
    rest = [c for c in bank.columns if c not in ("bank_account_id", "bank_record_id", "was_duplicate")]
    before = F.bool_or("was_duplicate") if "was_duplicate" in bank.columns else F.lit(False)
    return bank.groupBy("bank_account_id", "bank_record_id").agg(*(F.any_value(c).alias(c) for c in rest), F.count("*").alias("copies"), before.alias("was_duplicate"))


REFERENCE = ("merchant_id", "currency", "settlement_id")


def ambiguous(target_keys: DataFrame) -> DataFrame:
    """References that name more than one settlement of a merchant and currency. Admission refuses them in a
    bundle, and every run in the state it leaves, where a stored settlement and a new one may meet."""
    named = target_keys.select(*REFERENCE, "processor", "settlement_cycle").distinct()
    return named.groupBy(*REFERENCE).agg(F.count("*").alias("n_targets")).where("n_targets > 1")


def target_index(target_keys: DataFrame) -> DataFrame:
    """One row a reference with its only target. An ambiguous one fails the job: money must not be allocated twice."""
    ends = target_keys.groupBy(*REFERENCE).agg(*(f(F.struct("processor", "settlement_cycle")).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))))
    refused = F.raise_error(F.concat_ws("/", F.lit("AMBIGUOUS_BANK_ALLOCATION: BANK_ENTRIES"), *REFERENCE))
    return ends.withColumn("t", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(refused.cast(ends.schema["low"].dataType))).select(*REFERENCE, "t.*")


def allocate(bank: DataFrame, target_keys: DataFrame, permitted: DataFrame) -> DataFrame:
    """One row a bank entry: its target by exact trimmed reference, disposition and reasons.

    permitted: merchant_id, currency, bank_account_id of the accounts that the policy names.
    """
    trimmed = outer_trim(F.col("settlement_reference"))
    entries = once(bank).withColumn("normalized_settlement_reference", F.when(trimmed != "", trimmed))
    accounts = permitted.select("merchant_id", "currency", "bank_account_id").distinct().withColumn("named", F.lit(True))
    entries = entries.join(accounts, ["merchant_id", "currency", "bank_account_id"], "left")
    sign = F.when(F.col("direction") == "CREDIT", 1).otherwise(-1)
    # Entries without a reference don't take part in the join, so null is no hot key.
    referring = entries.where("normalized_settlement_reference IS NOT NULL").join(
        target_index(target_keys).withColumn("target", F.lit(True)).withColumnRenamed("settlement_id", "normalized_settlement_reference"), ["merchant_id", "currency", "normalized_settlement_reference"], "left"
    )
    without = entries.where("normalized_settlement_reference IS NULL").select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("processor", "string"), ("settlement_cycle", "string"), ("target", "boolean"))))
    both = referring.unionByName(without).withColumn("account_permitted", F.when(F.col("target"), F.col("named").isNotNull()))
    again = (F.col("copies") > 1) | F.col("was_duplicate")
    return both.select(
        "bank_account_id", "bank_record_id", "merchant_id", "currency", "normalized_settlement_reference",
        F.when(F.col("target"), DISPOSITIONS[0]).when(F.col("normalized_settlement_reference").isNull(), DISPOSITIONS[1]).otherwise(DISPOSITIONS[2]).alias("disposition"),
        F.when(F.col("target"), derived_id("stl:", {k: "normalized_settlement_reference" if k == "settlement_id" else k for k in KEYS})).alias("settlement_reconciliation_key"),
        (sign * F.col("amount_minor")).cast("bigint").alias("signed_minor"), "account_permitted", (F.col("copies") > 1).alias("duplicate_current_bundle"),
        joined(reasons({"UNALLOCATED_BANK_MOVEMENT": F.col("target").isNull(), "INVALID_BANK_ACCOUNT": ~F.col("account_permitted"), "DUPLICATE_BANK_MOVEMENT": again})).alias("reason_codes"),
        "processor", "settlement_cycle", again.alias("duplicate"),
    )


def published(allocations: DataFrame) -> DataFrame:
    """The columns of an allocation result."""
    return allocations.drop("processor", "settlement_cycle", "duplicate")


def reconcile(settlements: DataFrame, journals: DataFrame, allocations: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """One row a settlement key: three totals, three deltas, status and ordered reasons.

    The three sides are tagged and meet in one aggregate over the key; allocations come from allocate.
    """
    zero, no = F.lit(0).cast(MONEY), F.lit(False)

    def side(df: DataFrame, **own) -> DataFrame:
        every = {"p_minor": zero, "l_minor": zero, "b_minor": zero, "p": F.lit(0), "l": F.lit(0), "b": F.lit(0), "role": no, "formula": no, "account": no, "again": no} | own
        return df.select(*KEYS, *(v.alias(k) for k, v in every.items()))

    either_side = F.exists("postings", lambda p: (p["account_role"] == CLEARING) & (p["side"] == "DEBIT"))
    moved = journal_movement(journals, either_side, -1, policy.settlement_counterparts)
    allocated = allocations.where("disposition = 'ALLOCATED'").withColumnRenamed("normalized_settlement_reference", "settlement_id")
    rows = (
        side(net(settlements), p_minor=F.col("net_minor").cast(MONEY), p=F.lit(1), formula=F.col("formula_mismatch"))
        .unionByName(side(moved, l_minor=F.col("movement_minor"), l=F.lit(1), role=F.col("invalid_role")))
        .unionByName(side(allocated, b_minor=F.col("signed_minor").cast(MONEY), b=F.lit(1), account=~F.col("account_permitted"), again=F.col("duplicate")))
    )
    total = lambda c: F.sum(c).cast("bigint")
    s = rows.groupBy(*KEYS).agg(
        total("p_minor").alias("processor_net_minor"), total("l_minor").alias("ledger_clearing_minor"), total("b_minor").alias("bank_minor"),
        total("p").alias("processor_settlement_count"), total("l").alias("ledger_journal_count"), total("b").alias("allocated_bank_entry_count"),
        *(F.bool_or(c).alias(c) for c in ("role", "formula", "account", "again")),
    )
    d = s.select("*", (F.col("processor_net_minor") - F.col("ledger_clearing_minor")).alias(DELTAS[0]), (F.col("processor_net_minor") - F.col("bank_minor")).alias(DELTAS[1]), (F.col("ledger_clearing_minor") - F.col("bank_minor")).alias(DELTAS[2]))
    d = d.withColumn("difference_minor", F.greatest(*(F.abs(c) for c in DELTAS)))
    needed = (F.col("processor_settlement_count") > 0) & (F.col("processor_net_minor") != 0)
    owned = reasons({
        "INVALID_ACCOUNT_ROLE": F.col("role"), "MISSING_LEDGER_MOVEMENT": needed & (F.col("ledger_journal_count") == 0),
        "MISSING_PROCESSOR_ACTIVITY": F.col("processor_settlement_count") == 0, "MISSING_BANK_SETTLEMENT": needed & (F.col("allocated_bank_entry_count") == 0),
        "INVALID_BANK_ACCOUNT": F.col("account"), "DUPLICATE_BANK_MOVEMENT": F.col("again"), "SETTLEMENT_FORMULA_MISMATCH": F.col("formula"),
    })
    mismatch = reasons({name: F.col(c) != 0 for name, c in zip(REASONS[-3:], DELTAS, strict=True)})
    status = F.when(F.size("owned") > 0, "EXCEPTION").when(F.col("difference_minor") == 0, "MATCHED").when(F.col("difference_minor") <= tolerance(policy.settlement_tolerance), "WITHIN_TOLERANCE").otherwise("EXCEPTION")
    codes = F.when(F.size("owned") > 0, F.col("owned")).when(F.col("status") == "MATCHED", F.array().cast("array<string>")).when(F.col("status") == "WITHIN_TOLERANCE", F.array(F.lit("TOLERATED_DIFFERENCE"))).otherwise(mismatch)
    return d.withColumn("owned", owned).withColumn("status", status).select(derived_id("stl:", KEYS).alias("reconciliation_key"), *KEYS, *TOTALS, "status", joined(codes).alias("reason_codes"))


def sources(settlements: DataFrame, journals: DataFrame, allocations: DataFrame) -> DataFrame:
    """(key, source_identity) of every record behind a settlement row."""
    key = derived_id("stl:", KEYS).alias("reconciliation_key")
    left = settlements.select(key, F.array(F.lit("PROCESSOR_SETTLEMENT"), "processor", "source_record_id").alias("source_identity"))
    right = journals.select(key, F.array(F.lit("LEDGER_JOURNAL"), "ledger_system", "journal_id").alias("source_identity"))
    bank = allocations.where("disposition = 'ALLOCATED'").select(F.col("settlement_reconciliation_key").alias("reconciliation_key"), F.array(F.lit("BANK_ENTRY"), "bank_account_id", "bank_record_id").alias("source_identity"))
    return left.unionByName(right).unionByName(bank)
