"""Two-way reconciliation of processor events and ledger journals by transaction key.

One plan: events, journals and reference flags become tagged contributions of equal shape and meet
in a single aggregate over the key, in place of a full outer join of two aggregates and two more
joins for flags. ``by`` names further key columns, such as a run, that separate everything.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.columns import MONEY, derived_id, joined, money_sum, reasons
from concordat.operators.policy import CLEARING, DEFAULT, Policy

# Key components, entry types and reason codes in their order.
KEYS = ("processor", "merchant_id", "payment_id", "event_class", "currency")
ENTRY_TYPES = ("CAPTURE", "REFUND", "CHARGEBACK", "REVERSAL")
REASONS = ("INVALID_ACCOUNT_ROLE", "UNRESOLVED_REFERENCE", "OVER_APPLIED_REFERENCE", "MISSING_LEDGER_MOVEMENT", "MISSING_PROCESSOR_ACTIVITY", "PROCESSOR_LEDGER_MISMATCH")
TOTALS = ("processor_minor", "ledger_minor", "processor_ledger_delta_minor", "difference_minor", "processor_record_count", "ledger_journal_count")
#: What the event of a capture and those that refer to it have in common.
SCOPE = ("processor", "merchant_id", "payment_id", "currency")


def event_identity() -> Column:
    return F.array(F.lit("PROCESSOR_EVENT"), "processor", "source_record_id")


def journal_identity() -> Column:
    return F.array(F.lit("LEDGER_JOURNAL"), "ledger_system", "journal_id")


def tolerance(limits: Mapping[str, int]) -> Column:
    """A currency's tolerance; a currency without one is rejected, never waved through."""
    table = F.create_map(*(F.lit(x).cast("bigint") if isinstance(x, int) else F.lit(x) for pair in sorted(limits.items()) for x in pair))
    return F.coalesce(F.try_element_at(table, F.col("currency")), F.raise_error(F.concat(F.lit("POLICY_MISMATCH: no tolerance for "), F.col("currency"))).cast("bigint"))


def applications(events: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """What reversing events apply to one capture, by scope and reference: applied_minor, classes
    (event types), capture_minor (null if no capture of that scope has the id) and the two flags.

    Events are added up before they meet the captures, so no capture gathers its events in a window.
    """
    scope = [*by, *SCOPE, "reference_event_id"]
    applied = events.where("event_type <> 'CAPTURE'").groupBy(*scope).agg(money_sum(F.col("amount_minor")).alias("applied_minor"), F.collect_set("event_type").alias("classes"))
    captures = events.where("event_type = 'CAPTURE'").select(*scope[:-1], F.col("source_record_id").alias("reference_event_id"), F.col("amount_minor").alias("capture_minor"))
    over = F.coalesce(F.col("applied_minor") > F.col("capture_minor"), F.lit(False))
    return applied.join(captures, scope, "left").withColumn("unresolved", F.col("capture_minor").isNull()).withColumn("over_applied", over)


def unresolved_events(events: DataFrame) -> DataFrame:
    """Reversing events whose reference names no capture of their scope, and captures that carry a reference."""
    captures = events.where("event_type = 'CAPTURE'").select(*SCOPE, F.col("source_record_id").alias("reference_event_id"))
    missing = events.where("event_type <> 'CAPTURE'").join(captures, [*SCOPE, "reference_event_id"], "left_anti").select(*events.columns)
    return missing.unionByName(events.where("event_type = 'CAPTURE' AND reference_event_id IS NOT NULL"))


def capacity(events: DataFrame) -> DataFrame:
    """Every capture with what was applied to it, what remains, and its verdict."""
    captures = events.where("event_type = 'CAPTURE'").select(*SCOPE, F.col("source_record_id").alias("capture_id"), F.col("amount_minor").alias("captured_minor"))
    used = events.where("event_type <> 'CAPTURE'").groupBy(*SCOPE, F.col("reference_event_id").alias("capture_id")).agg(money_sum(F.col("amount_minor")).alias("applied_minor"))
    both = captures.join(used, [*SCOPE, "capture_id"], "left").withColumn("applied_minor", F.coalesce("applied_minor", F.lit(0).cast("bigint")))
    verdict = F.when(F.col("applied_minor") > F.col("captured_minor"), "OVER_APPLIED").otherwise("VALID")
    return both.select("processor", "capture_id", "captured_minor", "applied_minor", (F.col("captured_minor") - F.col("applied_minor")).alias("remaining_minor"), verdict.alias("verdict"))


def journal_movement(journals: DataFrame, expected_debit: Column, sign_debit: int, counterparts: tuple[str, ...]) -> DataFrame:
    """journals with movement_minor and invalid_role, computed inside the postings array."""
    clearing = F.filter("postings", lambda p: p["account_role"] == CLEARING)
    signed = F.reduce(clearing, F.lit(0).cast(MONEY), lambda s, p: (s + F.when(p["side"] == "DEBIT", sign_debit).otherwise(-sign_debit) * p["amount_minor"].cast(MONEY)).cast(MONEY))
    wrong_counterpart = F.exists("postings", lambda p: (p["account_role"] != CLEARING) & ~p["account_role"].isin(*counterparts))
    wrong_side = F.exists(clearing, lambda p: (p["side"] == "DEBIT") != expected_debit)
    return journals.withColumn("movement_minor", signed).withColumn("invalid_role", wrong_counterpart | (F.size(clearing) != 1) | wrong_side)


def flags(events: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Flagged applications, a row for each of their event classes."""
    return applications(events, by).where("unresolved OR over_applied").withColumn("event_class", F.explode("classes"))


def flags_of_runs(events: DataFrame, runs: int) -> DataFrame:
    """``flags`` of every run (as since and until) from one sum; events have since, the first run that sees them."""
    scope = [*SCOPE, "reference_event_id"]
    so_far = F.array(*(F.sum(F.when(F.col("since") <= r, F.col("amount_minor").cast(MONEY))).cast("bigint") for r in range(1, runs + 1)))
    applied = events.where("event_type <> 'CAPTURE'").groupBy(*scope).agg(F.collect_set(F.struct("event_type", "since")).alias("classes"), so_far.alias("applied"))
    captures = events.where("event_type = 'CAPTURE'").select(*SCOPE, F.col("source_record_id").alias("reference_event_id"), F.col("amount_minor").alias("capture_minor"), F.col("since").alias("captured"))

    def verdict(r: int) -> Column:
        known = F.coalesce(F.col("captured") <= r, F.lit(False))
        return F.struct(F.lit(r).alias("run"), (~known).alias("unresolved"), (known & F.coalesce(F.col("applied")[r - 1] > F.col("capture_minor"), F.lit(False))).alias("over_applied"))

    each = applied.join(captures, scope, "left").select(*SCOPE, "classes", F.explode(F.array(*map(verdict, range(1, runs + 1)))).alias("f")).where("f.unresolved OR f.over_applied")
    return each.select(*SCOPE, "f.*", F.explode("classes").alias("c")).where("c.since <= run").select(*SCOPE, F.col("c.event_type").alias("event_class"), "unresolved", "over_applied", F.col("run").alias("since"), F.col("run").alias("until"))


def contributions(events: DataFrame, journals: DataFrame, policy: Policy, by: tuple[str, ...], flagged: DataFrame | None = None, listed: bool = False) -> DataFrame:
    """Tagged rows of both sides, and of the flags (those of ``flags`` unless given), with the transaction key; listed: and with their record's identity."""
    event_id, journal_id = ({"source_identity": v} if listed else {} for v in (event_identity(), journal_identity()))
    none = {"source_identity": F.lit(None).cast("array<string>")} if listed else {}
    no, zero = F.lit(False), F.lit(0).cast(MONEY)

    def rows(df: DataFrame, event_class: Column, **own: Column) -> DataFrame:
        every = {"processor_minor": zero, "ledger_minor": zero, "p": F.lit(0), "l": F.lit(0), "unresolved": no, "over_applied": no, "invalid_role": no} | own
        return df.select(*by, "processor", "merchant_id", "payment_id", event_class.alias("event_class"), "currency", *(v.alias(k) for k, v in every.items()))

    sign = F.when(F.col("event_type") == "CAPTURE", 1).otherwise(-1)
    misused = (F.col("event_type") == "CAPTURE") & F.col("reference_event_id").isNotNull()
    flagged = flags(events, by) if flagged is None else flagged
    moved = journal_movement(journals, F.col("entry_type") == "CAPTURE", 1, policy.transaction_counterparts)
    return (
        rows(events, F.col("event_type"), processor_minor=sign * F.col("amount_minor").cast(MONEY), p=F.lit(1), unresolved=misused, **event_id)
        .unionByName(rows(moved, F.col("entry_type"), ledger_minor=F.col("movement_minor"), l=F.lit(1), invalid_role=F.col("invalid_role"), **journal_id))
        .unionByName(rows(flagged, F.col("event_class"), unresolved=F.col("unresolved"), over_applied=F.col("over_applied"), **none))
    )


def reconcile(events: DataFrame, journals: DataFrame, policy: Policy = DEFAULT, by: tuple[str, ...] = (), listed: bool = False) -> DataFrame:
    """One row a transaction key: totals, difference, status and ordered reasons; listed: and source_identities, as ``results.packed`` lists them."""
    sums = _sums() | ({"source_identities": F.array_sort(F.collect_set("source_identity"))} if listed else {})
    return judged(contributions(events, journals, policy, by, listed=listed).groupBy(*by, *KEYS).agg(*(v.alias(k) for k, v in sums.items())), policy, by)


def _sums(seen: Column | None = None, unresolved: str = "unresolved", over_applied: str = "over_applied") -> dict[str, Column]:
    """Aggregates of a key's contributions, of those seen only where that is given; the flags' columns by name."""
    own = lambda c: F.col(c) if seen is None else F.when(seen, F.col(c))
    some = lambda c: F.bool_or(own(c)) if seen is None else F.coalesce(F.bool_or(own(c)), F.lit(False))
    total = lambda c: F.sum(own(c)) if seen is None else F.coalesce(F.sum(own(c)), F.lit(0))
    return {
        "processor_minor": total("processor_minor").cast("bigint"), "ledger_minor": total("ledger_minor").cast("bigint"),
        "processor_record_count": total("p").cast("bigint"), "ledger_journal_count": total("l").cast("bigint"),
        "unresolved": some(unresolved), "over_applied": some(over_applied), "invalid_role": some("invalid_role"),
    }


def judged(summed: DataFrame, policy: Policy, by: tuple[str, ...] = ()) -> DataFrame:
    """Aggregates of ``_sums`` with their key, difference, status and ordered reasons."""
    delta = summed.withColumn("processor_ledger_delta_minor", F.col("processor_minor") - F.col("ledger_minor")).withColumn("difference_minor", F.abs("processor_ledger_delta_minor"))
    tests = (F.col("invalid_role"), F.col("unresolved"), F.col("over_applied"), F.col("ledger_journal_count") == 0, F.col("processor_record_count") == 0)
    owned = reasons(dict(zip(REASONS, tests, strict=False)))
    status = F.when(F.size("owned") > 0, "EXCEPTION").when(F.col("difference_minor") == 0, "MATCHED").when(F.col("difference_minor") <= tolerance(policy.transaction_tolerance), "WITHIN_TOLERANCE").otherwise("EXCEPTION")
    codes = F.when(F.size("owned") > 0, F.col("owned")).when(F.col("status") == "MATCHED", F.array().cast("array<string>")).when(F.col("status") == "WITHIN_TOLERANCE", F.array(F.lit("TOLERATED_DIFFERENCE"))).otherwise(F.array(F.lit(REASONS[-1])))
    ready = delta.withColumn("owned", owned).withColumn("status", status).withColumn("reason_codes", joined(codes))
    return ready.select(*by, derived_id("txn:", KEYS).alias("reconciliation_key"), *KEYS, *TOTALS, "status", "reason_codes", *(c for c in summed.columns if c == "source_identities"))


def histories(events: DataFrame, journals: DataFrame, runs: int, policy: Policy = DEFAULT) -> DataFrame:
    """run, revision and the columns of ``reconcile`` for all runs of a history, 1 to runs, from one shuffle.

    events, journals: with since, the first run that sees a record; later runs see it too. A key's runs are
    summed side by side in one row before they are told apart, so records aren't multiplied, a key's
    revisions count without a window, and what is then grouped or ordered by KEYS isn't shuffled again.
    """
    shown = [df.withColumn("until", F.lit(runs)) for df in (events, journals)]
    seen = {r: (F.col("since") <= r) & (F.col("until") >= r) for r in range(1, runs + 1)}
    sums = {f"{k}_{r}": v for r, test in seen.items() for k, v in _sums(test).items()}
    summed = contributions(*shown, policy, ("since", "until"), flags_of_runs(events, runs)).groupBy(*KEYS).agg(*(v.alias(k) for k, v in sums.items()))
    held = lambda r: F.col(f"processor_record_count_{r}") + F.col(f"ledger_journal_count_{r}") > 0
    row = lambda r: F.struct(F.lit(r).alias("run"), sum((held(q).cast("int") for q in range(2, r + 1)), held(1).cast("int")).alias("revision"), *(F.col(f"{k}_{r}").alias(k) for k in _sums()))
    each = summed.select(*KEYS, F.explode(F.array(*(F.when(held(r), row(r)) for r in seen))).alias("r")).where("r IS NOT NULL")
    return judged(each.select(*KEYS, "r.*"), policy, ("run", "revision"))


def sources(events: DataFrame, journals: DataFrame) -> DataFrame:
    """(key, source_identity) of every record behind a transaction row."""
    left = events.select("processor", "merchant_id", "payment_id", F.col("event_type").alias("event_class"), "currency", event_identity().alias("source_identity"))
    right = journals.select("processor", "merchant_id", "payment_id", F.col("entry_type").alias("event_class"), "currency", journal_identity().alias("source_identity"))
    return left.unionByName(right)
