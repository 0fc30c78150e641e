"""Admission gates as one violations frame: (rule, family, identity, detail), and replay handling.

Every rule of a family's rows is tested in one scan; identities, currencies and settlement ids are
partial aggregates. A batch with any violation is refused before anything is written.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions.columns import MONEY, business_digest, moment, nfc, plain_ascii, reasons
from concordat.operators import settlements as stl
from concordat.operators import transactions as txn
from concordat.operators.policy import Policy

VIOLATION = ("rule", "family", "identity", "detail")
# Identities, what may be null, closed domains, amounts that must be positive or not negative, moments.
IDENTITIES: dict[str, tuple[str, ...]] = {
    "PROCESSOR_EVENTS": ("processor", "source_record_id"), "PROCESSOR_SETTLEMENTS": ("processor", "source_record_id"),
    "LEDGER_JOURNALS": ("ledger_system", "journal_id"), "BANK_ENTRIES": ("bank_account_id", "bank_record_id"),
}
OPTIONAL = {"PROCESSOR_EVENTS": ("reference_event_id",), "LEDGER_JOURNALS": ("payment_id", "settlement_id", "settlement_cycle"), "BANK_ENTRIES": ("settlement_reference",)}
DOMAINS = {"PROCESSOR_EVENTS": {"event_type": txn.ENTRY_TYPES}, "LEDGER_JOURNALS": {"entry_type": (*txn.ENTRY_TYPES, *stl.ENTRY_TYPES)}, "BANK_ENTRIES": {"direction": ("CREDIT", "DEBIT")}}
POSITIVE = {"PROCESSOR_EVENTS": ("amount_minor",), "BANK_ENTRIES": ("amount_minor",)}
NOT_NEGATIVE = {"PROCESSOR_SETTLEMENTS": ("gross_minor", "fee_minor", "refund_minor", "chargeback_minor", "reserve_minor")}
MOMENTS = {"PROCESSOR_EVENTS": ("occurred_at", "received_at"), "PROCESSOR_SETTLEMENTS": ("occurred_at", "received_at"), "LEDGER_JOURNALS": ("effective_at", "received_at"), "BANK_ENTRIES": ("value_at", "received_at")}
POSTING_FIELDS = ("account_role", "amount_minor", "line_id", "side")


def _row(df: DataFrame, rule: str | Column, family: str, identity: Column, detail: Column) -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(rule.alias("rule"), F.lit(family).alias("family"), identity.cast("string").alias("identity"), detail.cast("string").alias("detail"))


def required(df: DataFrame, family: str, identity: str, columns: tuple[str, ...]) -> DataFrame:
    """Rows with a null in a required column; all columns are tested in one scan."""
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns)))
    return _row(df.withColumn("m", missing).where(F.size("m") > 0), "REQUIRED_FIELD", family, F.col(identity), F.array_join("m", ","))


def payload_digest(df: DataFrame) -> Column:
    """SHA-256 of a record's canonical JSON without its transport fields; postings in the order of their names."""
    ordered = F.transform("postings", lambda p: F.struct(*(p[f].alias(f) for f in POSTING_FIELDS))) if "postings" in df.columns else None
    return business_digest({c: ordered if c == "postings" else F.col(c) for c in df.columns})


def row_rules(df: DataFrame, family: str, policy: Policy) -> dict[str, Column]:
    """Rules of single records, each true where it is broken; names are rule and detail with a colon."""
    names = df.columns
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    rules: dict[str, Column] = {}
    for c in names:
        if c not in OPTIONAL.get(family, ()):
            rules[f"SCHEMA_VIOLATION:{c} is null"] = F.col(c).isNull()
    for c in texts:
        rules[f"SCHEMA_VIOLATION:{c} holds control characters"] = F.col(c).rlike(r"[\x00-\x1F]")
        if c != "settlement_reference":
            rules[f"SCHEMA_VIOLATION:{c} is empty or has outer blanks"] = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1)).rlike(r"(?U)^$|\s")
    for c, allowed in DOMAINS.get(family, {}).items():
        rules[f"SCHEMA_VIOLATION:unknown {c}"] = ~F.col(c).isin(*allowed)
    for c in POSITIVE.get(family, ()):
        rules[f"SCHEMA_VIOLATION:{c} is not positive"] = F.col(c) <= 0
    for c in NOT_NEGATIVE.get(family, ()):
        rules[f"SCHEMA_VIOLATION:{c} is negative"] = F.col(c) < 0
    for c in MOMENTS[family]:
        if c in names:
            rules[f"SCHEMA_VIOLATION:{c} is no moment"] = F.col(c).isNotNull() & moment(F.col(c)).isNull()
    rules["SCHEMA_VIOLATION:schema version"] = F.col("schema_version") != "2.0"
    rules["SCHEMA_VIOLATION:unsupported currency"] = ~F.col("currency").isin(*policy.currencies)
    if family == "PROCESSOR_EVENTS":
        rules["SCHEMA_VIOLATION:reference"] = (F.col("event_type") == "CAPTURE") == F.col("reference_event_id").isNotNull()
    if family == "LEDGER_JOURNALS":
        own = F.col("entry_type").isin(*txn.ENTRY_TYPES)
        keyed = F.col("settlement_id").isNotNull() & F.col("settlement_cycle").isNotNull()
        part = F.col("settlement_id").isNotNull() | F.col("settlement_cycle").isNotNull()
        rules["UNBALANCED_JOURNAL:business key"] = (own & (F.col("payment_id").isNull() | part)) | (~own & (F.col("payment_id").isNotNull() | ~keyed))
        rules |= {f"UNBALANCED_JOURNAL:{k}": v for k, v in posting_rules().items()}
    rules["SOURCE_IDENTITY_MISMATCH:payload digest"] = payload_digest(df) != F.col("payload_sha256")
    return rules


def row_violations(df: DataFrame, family: str, policy: Policy) -> DataFrame:
    """All broken rules of all records: one scan, one row for each.

    Rules stand in the generator itself: as a column that a filter tests, they would be pushed into the
    scan with all that the record's columns are derived from, computed again for every mention.
    """
    broken = reasons({k: F.coalesce(v, F.lit(False)) for k, v in row_rules(df, family, policy).items()})
    identity = F.concat_ws("/", *IDENTITIES[family])
    each = df.select(identity.alias("identity"), F.explode(broken).alias("b"))
    return _row(each, F.split_part("b", F.lit(":"), F.lit(1)), family, F.col("identity"), F.split_part("b", F.lit(":"), F.lit(2)))


def posting_rules() -> dict[str, Column]:
    """Rules of a journal's postings, each true where it is broken."""
    side = lambda name: F.reduce(F.filter("postings", lambda p: p["side"] == name), F.lit(0).cast(MONEY), lambda s, p: (s + p["amount_minor"]).cast(MONEY))
    return {
        "TOO_FEW_POSTINGS": F.size("postings") < 2,
        "REPEATED_LINE": F.size(F.array_distinct(F.transform("postings", lambda p: p["line_id"]))) != F.size("postings"),
        "AMOUNT_NOT_POSITIVE": F.exists("postings", lambda p: p["amount_minor"] <= 0),
        "UNKNOWN_SIDE": F.exists("postings", lambda p: ~p["side"].isin("DEBIT", "CREDIT")),
        "UNBALANCED": side("DEBIT") != side("CREDIT"),
    }


def journal_violations(journals: DataFrame) -> DataFrame:
    """Journals that are not two or more distinct positive postings in balance, with the rules broken."""
    return journals.withColumn("broken", reasons(posting_rules())).where(F.size("broken") > 0).select("journal_id", F.array_join("broken", "|").alias("broken"))


def identity_conflicts(df: DataFrame, identity: tuple[str, ...], digest: str = "payload_sha256") -> DataFrame:
    """Identities with more than one payload; least and greatest digest say so without collecting them."""
    ends = df.groupBy(*identity).agg(F.min(digest).alias("low"), F.max(digest).alias("high"), F.count("*").alias("n_rows"))
    return ends.where("low < high").select(*identity, "n_rows")


def replay_once(df: DataFrame, identity: tuple[str, ...], digest: str = "payload_sha256") -> DataFrame:
    return df.dropDuplicates([*identity, digest])


def replay_order(df: DataFrame, identity: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Adds occurrence (1 for the first of an identity in that order) and replayed."""
    seen = F.row_number().over(Window.partitionBy(*identity).orderBy(*order))
    return df.withColumn("occurrence", seen).withColumn("replayed", F.col("occurrence") > 1)


def replay_counts(df: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """n_rows, n_identities and n_replayed of a family."""
    per = df.groupBy(*identity).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_identities")).withColumn("n_replayed", F.col("n_rows") - F.col("n_identities"))


def currency_domains(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys (without currency) that hold more than one currency."""
    return df.groupBy(*keys).agg(F.count_distinct("currency").alias("n_currencies")).where("n_currencies > 1")


def gates(found: Mapping[str, DataFrame], policy: Policy) -> DataFrame:
    """Every violation of a bundle's four families."""
    events, sets, journals, bank = (found[f] for f in ("PROCESSOR_EVENTS", "PROCESSOR_SETTLEMENTS", "LEDGER_JOURNALS", "BANK_ENTRIES"))
    frames = [row_violations(df, family, policy) for family, df in found.items()]
    for family, df in found.items():
        conflicts = identity_conflicts(df, IDENTITIES[family])
        frames.append(_row(conflicts, "IDENTITY_CONFLICT", family, F.concat_ws("/", *IDENTITIES[family]), F.col("n_rows")))
    paid, settled = journals.where("payment_id IS NOT NULL"), journals.where("settlement_id IS NOT NULL")
    grain, cycle = txn.KEYS[:4], stl.KEYS[:4]
    both = events.select(*grain[:3], F.col("event_type").alias("event_class"), "currency").unionByName(paid.select(*grain[:3], F.col("entry_type").alias("event_class"), "currency"))
    frames.append(_row(currency_domains(both, grain), "CURRENCY_DOMAIN_VIOLATION", "TRANSACTION", F.concat_ws("/", *grain), F.col("n_currencies")))
    both = sets.select(*cycle, "currency").unionByName(settled.select(*cycle, "currency"))
    frames.append(_row(currency_domains(both, cycle), "CURRENCY_DOMAIN_VIOLATION", "SETTLEMENT", F.concat_ws("/", *cycle), F.col("n_currencies")))
    return violations(*frames, ambiguous_targets(sets, journals))


def ambiguous_targets(sets: DataFrame, journals: DataFrame) -> DataFrame:
    """Violations: references with more than one settlement, of a bundle or of a whole state."""
    unclear = stl.ambiguous(stl.named(sets, journals.where("settlement_id IS NOT NULL")))
    return _row(unclear, "AMBIGUOUS_BANK_ALLOCATION", "BANK_ENTRIES", F.concat_ws("/", *stl.REFERENCE), F.col("n_targets"))


def normalised(df: DataFrame) -> DataFrame:
    """All texts in Unicode NFC, those of postings too. Plain ASCII families, nearly all, don't meet the Arrow function.

    Postings are normalised as one text of the whole array, because a Python function can't stand in a lambda.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c, kind in kinds.items() if kind.typeName() == "string" and c != "payload_sha256"]
    text = {c: F.col(c) for c in names} | {c: F.to_json(c) for c, kind in kinds.items() if kind.typeName() == "array"}
    if not text:
        return df
    other = reduce(lambda a, b: a | b, (F.coalesce(~plain_ascii(t), F.lit(False)) for t in text.values()))
    if df.where(other).isEmpty():
        return df
    return df.withColumns({c: nfc(t) if c in names else F.from_json(nfc(t), kinds[c]) for c, t in text.items()})


def overflows(df: DataFrame, family: str, keys: tuple[str, ...], amount: str = "amount_minor") -> DataFrame:
    """Violations: keys whose amounts add up to more than 64 bits hold; the detail is the exact sum.

    Reconciliation would abort at such a key without naming it. Sums are exact in decimals and partial before the shuffle.
    """
    total = df.groupBy(*keys).agg(F.sum(F.col(amount).cast(MONEY)).alias("total"))
    return _row(total.where(F.abs("total") > F.lit((1 << 63) - 1).cast(MONEY)), "ARITHMETIC_OVERFLOW", family, F.concat_ws("/", *keys), F.col("total"))


def admitted(found: Mapping[str, DataFrame], policy: Policy) -> dict[str, DataFrame]:
    """The families after all gates, replays dropped; bank entries keep theirs, which count as duplicates."""
    ready = {family: normalised(df) for family, df in found.items()}
    admit(gates(ready, policy))
    return {family: df if family == "BANK_ENTRIES" else replay_once(df, IDENTITIES[family]) for family, df in ready.items()}


def violations(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class Refused(ValueError):
    """A bundle that admission refuses; nothing of it may be used."""


def admit(found: DataFrame) -> None:
    """Refuse the batch if there is any violation; one small job, no output before it."""
    first = found.take(1)
    if first:
        raise Refused(f"ADMISSION {first[0].rule}: {first[0].family} {first[0].identity} {first[0].detail}")
