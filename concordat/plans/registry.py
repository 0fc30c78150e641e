"""All registered reconciliation queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions.columns import canonical_base64, counter_hash, derived_id, exact_amount, seconds_after, semantic_id
from concordat.operators import admission, compare, history, results, revisions, state
from concordat.operators import settlements as stl
from concordat.operators import transactions as txn
from concordat.operators.policy import DEFAULT
from concordat.plans.oracle import ORACLES
from concordat.sources import derived
from concordat.sources.tables import table
from concordat.streaming import windows

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
FLAGSHIP = "txn_recon"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _reconciled(s: SparkSession, d: str) -> DataFrame:
    return txn.reconcile(derived.events(s, d), derived.journals(s, d))


def _in_runs(df: DataFrame) -> DataFrame:
    """Records with the runs that see them: what came before the first bundle's day is in both."""
    return df.withColumn("run", F.explode(F.when(F.col("day") < derived.FIRST_DAYS, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))))


def _two_runs(s: SparkSession, d: str) -> DataFrame:
    """Results of both runs, from one plan with the run as a further key."""
    return txn.reconcile(_in_runs(derived.events(s, d)), _in_runs(derived.journals(s, d)), by=("run",))


def _allocated(s: SparkSession, d: str) -> DataFrame:
    return stl.allocate(derived.bank(s, d), _targets(s, d), derived.accounts(s, d))


def _three(s: SparkSession, d: str) -> DataFrame:
    return stl.reconcile(derived.settlements(s, d), derived.settlement_journals(s, d), _allocated(s, d))


def _targets(s: SparkSession, d: str) -> DataFrame:
    return stl.targets(derived.settlements(s, d), derived.settlement_journals(s, d))


def _allocations(s: SparkSession, d: str) -> DataFrame:
    return stl.published(_allocated(s, d))


def _history(s: SparkSession, d: str) -> DataFrame:
    """Every key's proofs, dealt by the key's components: the revision counts the key's runs, and each proof links to the one before."""
    at = derived.stored(s, d, "v_movement")
    seen = lambda df: df.withColumn("since", F.when(F.col("day") < derived.FIRST_DAYS, 1).otherwise(2))
    runs = txn.histories(seen(derived.events(s, at)), seen(derived.journals(s, at)), 2).select(*txn.KEYS, "reconciliation_key", "run", "status", "reason_codes", "difference_minor", "revision")
    numbered = runs.withColumn("manifest_sha256", F.concat(F.lit("m"), "run"))
    return numbered.withColumn("proof_id", revisions.proof_id(F.lit("transaction"), "revision", "manifest_sha256", F.lit("policy")))


IDENTITY = ("processor", "source_record_id")


def _planted(s: SparkSession, d: str) -> DataFrame:
    """Transaction results of which some contradict themselves."""
    rows, k = _reconciled(s, d), F.expr("CAST(substring(payment_id, 5) AS BIGINT)")
    return rows.select(
        "reconciliation_key", *(F.when(k % 53 == 0, F.lower("currency")).otherwise(F.col("currency")).alias("currency") if c == "currency" else F.when(k % 59 == 0, F.concat("merchant_id", F.lit("x"))).otherwise(F.col("merchant_id")).alias(c) if c == "merchant_id" else F.col(c) for c in txn.KEYS),
        *((F.col(c) + F.when(k % 37 == 0, 1).otherwise(0)).alias(c) if c == "processor_ledger_delta_minor" else (F.col(c) - F.when(k % 41 == 0, 9).otherwise(0)).alias(c) if c == "ledger_journal_count" else F.col(c) for c in txn.TOTALS),
        F.when(k % 43 == 0, "MATCHED").when(k % 61 == 0, "UNKNOWN").otherwise(F.col("status")).alias("status"), F.when(k % 47 == 0, "NO_SUCH_REASON").otherwise(F.col("reason_codes")).alias("reason_codes"),
    )


@registered
def txn_recon(s, d):
    return _reconciled(s, d)


@registered
def txn_unresolved_refs(s, d):
    return txn.unresolved_events(derived.events(s, d)).select("processor", "source_record_id", "reference_event_id", "event_type")


@registered
def txn_capture_capacity(s, d):
    return txn.capacity(derived.events(s, d))


@registered
def txn_packed(s, d):
    """Published rows with their sources; nested columns as text."""
    at = derived.stored(s, d, "v_movement")
    packed = results.packed(txn.reconcile(derived.events(s, at), derived.journals(s, at), listed=True), None, "transactions")
    return packed.select("reconciliation_key", F.to_json("key_components").alias("key_components"), F.to_json("totals").alias("totals"), "status", F.size("reason_codes").cast("bigint").alias("n_reasons"), F.to_json("source_identities").alias("source_identities"), "authoritative_proof")


@registered
def stl_packed(s, d):
    sets, journals, allocations = derived.settlements(s, d), derived.settlement_journals(s, d), _allocated(s, d)
    packed = results.packed(stl.reconcile(sets, journals, allocations), stl.sources(sets, journals, allocations), "settlements")
    return packed.select("reconciliation_key", F.to_json("key_components").alias("key_components"), F.col("totals.difference_minor").alias("difference_minor"), "status", F.to_json("source_identities").alias("source_identities"))


@registered
def journal_movement(s, d):
    moved = txn.journal_movement(derived.journals(s, d), F.col("entry_type") == "CAPTURE", 1, DEFAULT.transaction_counterparts)
    return moved.select("journal_id", F.col("movement_minor").cast("bigint").alias("movement_minor"), "invalid_role")


@registered
def journal_balance_violations(s, d):
    return admission.journal_violations(derived.raw_journals(s, d))


@registered
def admission_rows(s, d):
    """Every broken rule of every planted event record."""
    return admission.row_violations(derived.raw(s, d, "record").drop("k"), "PROCESSOR_EVENTS", DEFAULT)


@registered
def stl_net(s, d):
    return stl.net(derived.settlements(s, d)).select("source_record_id", "net_minor", "formula_mismatch")


@registered
def stl_three_way(s, d):
    return _three(s, d)


@registered
def bank_allocation(s, d):
    return _allocations(s, d)


@registered
def bank_duplicates(s, d):
    return stl.once(derived.bank(s, d)).where("copies > 1").select("bank_account_id", "bank_record_id", "copies")


@registered
def policy_accounts(s, d):
    """Bank entries by whether the policy's accounts hold theirs."""
    accounts = derived.accounts(s, d).withColumn("permitted", F.lit(True))
    rows = derived.bank(s, d).join(accounts, ["merchant_id", "currency", "bank_account_id"], "left")
    return rows.groupBy("merchant_id", "currency", F.coalesce("permitted", F.lit(False)).alias("permitted")).agg(F.count("*").alias("n_entries"))


@registered
def ambiguous_refs(s, d):
    return stl.ambiguous(derived.raw(s, d, "target"))


@registered
def settlement_targets(s, d):
    return _targets(s, d)


@registered
def identity_conflicts(s, d):
    return admission.identity_conflicts(derived.raw(s, d, "event"), IDENTITY)


@registered
def replay_dedup(s, d):
    once = admission.replay_once(derived.raw(s, d, "event"), IDENTITY)
    return once.groupBy("processor", "event_type").agg(F.count("*").alias("n_once"), F.sum("amount_minor").cast("bigint").alias("amount_minor"))


@registered
def replay_order(s, d):
    return admission.replay_order(derived.raw(s, d, "event"), IDENTITY, ("line",)).select("source_record_id", "processor", "line", F.col("occurrence").cast("bigint").alias("occurrence"), "replayed")


@registered
def replay_counts(s, d):
    return admission.replay_counts(derived.raw(s, d, "event"), IDENTITY).select(*(F.col(c).cast("bigint").alias(c) for c in ("n_rows", "n_identities", "n_replayed")))


@registered
def currency_domain(s, d):
    return admission.currency_domains(derived.raw(s, d, "event"), ("processor", "merchant_id", "payment_id", "event_type"))


@registered
def missing_side(s, d):
    rows = _reconciled(s, d).where("ledger_journal_count = 0 OR processor_record_count = 0")
    return rows.select("reconciliation_key", F.when(F.col("ledger_journal_count") == 0, "LEDGER").otherwise("PROCESSOR").alias("missing"))


@registered
def summary_transactions(s, d):
    return compare.summary(_reconciled(s, d), ("currency", "status", "reason_codes"), txn.TOTALS)


@registered
def summary_settlements(s, d):
    return compare.summary(_three(s, d), ("currency", "status", "reason_codes"), stl.TOTALS)


@registered
def summary_allocations(s, d):
    return compare.summary(_allocations(s, d), ("currency", "disposition", "reason_codes"), ("signed_minor",))


@registered
def summary_difference(s, d):
    """Groups of which the summary of the planted rows differs from that of the expected ones."""
    groups = ("currency", "status", "reason_codes")
    expected, actual = (compare.summary(rows, groups, txn.TOTALS) for rows in (_reconciled(s, d), _planted(s, d)))
    return compare.differences(expected, actual).select(*groups, "n_rows", "difference_minor", "side")


@registered
def summary_semantic_check(s, d):
    summary = compare.summary(_planted(s, d), ("currency", "status", "reason_codes"), txn.TOTALS)
    return results.summary_faults(summary, "status", txn.REASONS, txn.TOTALS)


@registered
def control_totals(s, d):
    total = lambda c, name: F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(name)
    return _three(s, d).groupBy("currency").agg(total("processor_net_minor", "processor_total"), total("ledger_clearing_minor", "ledger_total"), total("bank_minor", "bank_total"))


@registered
def control_totals_unequal(s, d):
    """Currencies whose three totals are not equal."""
    return control_totals(s, d).where("processor_total <> ledger_total OR processor_total <> bank_total").select("currency")


@registered
def batch_verdict(s, d):
    return compare.verdict(_three(s, d).select("reason_codes").unionByName(_allocations(s, d).select("reason_codes")), stl.REASONS)


@registered
def table_fingerprint(s, d):
    return compare.fingerprint(_reconciled(s, d), ("difference_minor", "reconciliation_key", "status"))


@registered
def recon_diff(s, d):
    columns = ("reconciliation_key", "status")
    runs = _two_runs(s, d)
    return compare.differences(runs.where("run = 1").select(*columns), runs.where("run = 2").select(*columns)).select(*columns, "side")


@registered
def derived_keys(s, d):
    keys = {"processor": "processor", "merchant_id": "merchant_id", "payment_id": "payment_id", "event_class": "event_type", "currency": "currency"}
    return derived.events(s, d).select(derived_id("txn:", keys).alias("reconciliation_key")).distinct()


@registered
def revision_chain(s, d):
    return revisions.chain(_history(s, d)).select("reconciliation_key", F.col("revision").cast("bigint").alias("revision"), "proof_id", F.col("position").cast("bigint").alias("position"), "predecessor_id")


@registered
def latest_heads(s, d):
    return revisions.heads(_history(s, d), txn.KEYS).select("reconciliation_key", F.col("revision").cast("bigint").alias("revision"), "proof_id", "status", "reason_codes")


@registered
def case_transitions(s, d):
    cases = history.derived_cases(_history(s, d), within=txn.KEYS).where("run = 2").withColumn("grain", F.lit("transaction"))
    return cases.withColumn("case_id", revisions.case_id()).select("reconciliation_key", "case_id", "case_status", F.col("case_revision").cast("bigint").alias("case_revision"), "reason_codes")


@registered
def state_containment(s, d):
    """Movements that no event holds with the same amount."""
    digest = lambda amount: F.sha2(amount.cast("string"), 256).alias("payload_sha256")
    every = derived._view(s, d, "v_movement").select(*IDENTITY, digest(F.col("amount_minor")))
    current = derived.events(s, d).select(*IDENTITY, digest(F.col("amount_minor") + F.when(F.col("k") % 89 == 0, 5).otherwise(0)))
    return state.missing_from(every, current, IDENTITY).select(*IDENTITY)


@registered
def state_merge(s, d):
    """Records by class of replay against a first run's state, and the merged state's size."""
    raw = derived.raw(s, d, "event").where("part <> 3")
    prior = raw.where(F.col("part") == 0).where(F.col("day") < derived.FIRST_DAYS)
    classes = state.classified(prior, raw, IDENTITY).groupBy("replay_class").agg(F.count("*").alias("n_rows"))
    merged = state.merge(prior, raw.where("part = 0"), IDENTITY).agg(F.count("*").alias("n_rows")).select(F.lit("MERGED").alias("replay_class"), "n_rows")
    return classes.unionByName(merged)


@registered
def row_semantic_check(s, d):
    return results.row_faults(_planted(s, d), "transactions")


@registered
def allocation_semantic_check(s, d):
    k = F.length("bank_record_id") + F.col("signed_minor")
    rows = _allocations(s, d).withColumn("disposition", F.when(k % 37 == 0, "ALLOCATED").when(k % 41 == 0, "LOST").otherwise(F.col("disposition"))).withColumn("account_permitted", F.when(k % 43 == 0, F.lit(None)).otherwise(F.col("account_permitted")))
    return results.allocation_faults(rows).distinct()


@registered
def merchant_rollup(s, d):
    """Counts and amounts by merchant and currency, applied amounts, and split deposits."""
    events = derived.events(s, d).groupBy("merchant_id", "currency").agg(F.count("*").alias("n_events"), F.sum("amount_minor").cast("bigint").alias("amount_minor"), F.sum(F.when(F.col("event_type") != "CAPTURE", F.col("amount_minor")).otherwise(0)).cast("bigint").alias("applied_minor"))
    deposits = derived.bank(s, d).groupBy("merchant_id", "currency").agg(F.count("*").alias("n_deposits"))
    return events.join(deposits, ["merchant_id", "currency"], "left").withColumn("n_deposits", F.coalesce("n_deposits", F.lit(0).cast("bigint")))


@registered
def gross_charges(s, d):
    """Positive amounts added up, negative ones apart, by currency."""
    signed = F.when(F.col("event_type") == "CAPTURE", F.col("amount_minor")).otherwise(-F.col("amount_minor"))
    part = lambda test, name: F.sum(F.when(test, F.abs(signed)).otherwise(0)).cast("bigint").alias(name)
    return derived.events(s, d).groupBy("currency").agg(part(signed > 0, "charged_minor"), part(signed < 0, "excluded_minor"), F.count_if(signed < 0).alias("n_excluded"))


@registered
def family_counts(s, d):
    frames = {"PROCESSOR_EVENTS": derived.events(s, d), "LEDGER_JOURNALS": derived.journals(s, d), "PROCESSOR_SETTLEMENTS": derived.settlements(s, d), "BANK_ENTRIES": derived.bank(s, d)}
    return admission.violations(*(df.agg(F.count("*").alias("n_rows")).select(F.lit(f).alias("family"), "n_rows") for f, df in frames.items()))


@registered
def scalar_functions(s, d):
    """Text amounts, base64, counter hashes, ids and moments of every order."""
    orders = table(s, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("t"))
    amount = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "0").when(F.col("o_orderkey") % 5 == 1, "-").otherwise(""), "t")
    code = F.concat(F.base64(F.col("t").cast("binary")), F.when(F.col("o_orderkey") % 7 == 0, "!").otherwise(""))
    return orders.select(
        "o_orderkey", exact_amount(amount).cast("string").alias("amount"), canonical_base64(code).cast("string").alias("decoded"), counter_hash(F.lit("seed"), F.col("t")).cast("string").alias("counter"),
        semantic_id("evt", F.lit("seed"), F.col("t")).alias("identifier"), seconds_after("2026-01-01T00:00:00Z", F.col("o_orderkey") % 86400).alias("moment"),
    )


@registered
def event_windows(s, d):
    return windows.hourly(table(s, d, "events"))
