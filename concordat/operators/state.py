"""State carried between runs: every record ever admitted, by family and identity.

A run reconciles the merged state, so late records change results by a new revision, references
resolve once their capture arrives, and bank entries wait for their settlement. Records are never
replaced: a stored identity with another payload is refused.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.columns import replay_class
from concordat.operators.admission import IDENTITIES, _row, admit, ambiguous_targets, violations

DUPLICATE = "was_duplicate"


def classified(prior: DataFrame, observed: DataFrame, identity: tuple[str, ...], digest: str = "payload_sha256") -> DataFrame:
    """observed with replay_class: DISTINCT, REPLAY or CONFLICT against the stored records."""
    stored = prior.groupBy(*identity).agg(F.min(digest).alias("stored_sha256"))
    return observed.join(stored, list(identity), "left").withColumn("replay_class", replay_class(F.col("stored_sha256"), F.col(digest))).drop("stored_sha256")


def conflicts(prior: Mapping[str, DataFrame], observed: Mapping[str, DataFrame]) -> DataFrame:
    """Violations: observed records whose stored identity has another payload."""
    frames = []
    for family, identity in IDENTITIES.items():
        wrong = classified(prior[family], observed[family], identity).where("replay_class = 'CONFLICT'")
        frames.append(_row(wrong, "IDENTITY_CONFLICT", family, F.concat_ws("/", *identity), F.lit("stored with another payload")))
    return violations(*frames)


def missing_from(prior: DataFrame, current: DataFrame, identity: tuple[str, ...], digest: str = "payload_sha256") -> DataFrame:
    """Prior records that the current state doesn't hold with the same payload."""
    return prior.join(current.select(*identity, digest).distinct(), [*identity, digest], "left_anti")


def merge(prior: DataFrame, observed: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """Stored and new records, each identity once. Payloads of one identity are equal, so the stored row stays as it is."""
    names = prior.columns
    rest = [c for c in names if c not in identity]
    both = prior.withColumn("seq", F.lit(0)).unionByName(observed.select(*names).withColumn("seq", F.lit(1)))
    first = F.min_by(F.struct(*rest), "seq").alias("r")
    return both.groupBy(*identity).agg(first).select(*identity, "r.*").select(*names)


def merge_bank(prior: DataFrame, observed: DataFrame) -> DataFrame:
    """Bank state, each identity once, with whether any bundle held it twice."""
    identity = IDENTITIES["BANK_ENTRIES"]
    names = [c for c in observed.columns if c != DUPLICATE]
    rest = [c for c in names if c not in identity]
    new = observed.groupBy(*identity).agg(F.any_value(F.struct(*rest)).alias("r"), (F.count("*") > 1).alias(DUPLICATE), F.lit(1).alias("seq"))
    old = prior.select(*identity, F.struct(*rest).alias("r"), DUPLICATE, F.lit(0).alias("seq"))
    both = old.unionByName(new).groupBy(*identity).agg(F.min_by("r", "seq").alias("r"), F.bool_or(DUPLICATE).alias(DUPLICATE))
    return both.select(*identity, "r.*", DUPLICATE)


def carried(prior: Mapping[str, DataFrame] | None, observed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The state after a run. Conflicts with what is stored refuse the run, and so do references that name one
    settlement of the stored records and another of the observed ones."""
    if prior is None:
        empty = observed["BANK_ENTRIES"].withColumn(DUPLICATE, F.lit(False)).limit(0)
        return dict(observed) | {"BANK_ENTRIES": merge_bank(empty, observed["BANK_ENTRIES"])}
    admit(conflicts(prior, observed))
    merged = {f: merge(prior[f], observed[f], identity) for f, identity in IDENTITIES.items() if f != "BANK_ENTRIES"}
    admit(ambiguous_targets(merged["PROCESSOR_SETTLEMENTS"], merged["LEDGER_JOURNALS"]))
    return merged | {"BANK_ENTRIES": merge_bank(prior["BANK_ENTRIES"], observed["BANK_ENTRIES"])}


def occurrences(state_bank: DataFrame, observed: DataFrame | None) -> DataFrame:
    """Bank state with the current bundle's repeats as rows of their own, which allocation counts."""
    if observed is None:
        return state_bank
    identity = IDENTITIES["BANK_ENTRIES"]
    repeats = observed.groupBy(*identity).agg(F.count("*").alias("n")).where("n > 1")
    again = state_bank.join(repeats, list(identity)).withColumn("at", F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))))
    return state_bank.unionByName(again.select(*state_bank.columns))
