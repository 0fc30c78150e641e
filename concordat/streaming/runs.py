"""A stream of records as a chain of runs: each micro-batch is one reconciliation on the merged state.

Micro-batch n is admitted as a bundle is, merged with what the runs before it left, reconciled, and
published as ``run-<n>`` in one rename. A micro-batch that comes again, after a failure or a restart,
finds its run and adds nothing, so every revision is appended once. A micro-batch that admission
refuses, by itself or against the state, leaves ``refused-<n>.json`` with the reason and no run; the
stream goes on. Its records are parsed and saved in columns once, and deleted when the run stands.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from concordat.operators.admission import Refused, admitted
from concordat.operators.compare import fingerprint
from concordat.operators.policy import Policy
from concordat.plans import engine
from concordat.sources.files import FAMILIES
from concordat.sources.publication import COMPLETED, Files, canonical_bytes, open_bundle, write_bundle

ENVELOPE = ("family", "record")


def envelopes(families: Mapping[str, DataFrame]) -> DataFrame:
    """Records of all families as (family, JSON text), so that one stream carries them in one micro-batch."""
    out = None
    for family, df in families.items():
        own = df.select(F.lit(family).alias("family"), F.to_json(F.struct(*df.columns)).alias("record"))
        out = own if out is None else out.unionByName(own)
    return out


class Runs:
    """The chain below a root folder, and the function that turns a micro-batch into its next run."""

    def __init__(self, spark: SparkSession, root: str, policy: Policy):
        self.spark, self.policy, self.files = spark, policy, Files(spark, root)

    def numbers(self) -> list[int]:
        """Numbers of the complete runs."""
        return sorted(int(n.removeprefix("run-")) for n in self.files.names() if n.startswith("run-") and self.files.exists(f"{n}/{COMPLETED}"))

    def tables(self, number: int | None = None) -> dict[str, DataFrame]:
        """The tables of a run, the newest by default, verified."""
        number = self.numbers()[-1] if number is None else number
        return open_bundle(self.spark, f"{self.files.root}/run-{number:09d}")

    def refusals(self) -> dict[int, str]:
        found = (n for n in self.files.names() if n.startswith("refused-"))
        return {int(n.removeprefix("refused-").removesuffix(".json")): json.loads(self.files.read(n))["reason"] for n in found}

    def _saved(self, batch: DataFrame, place: str) -> dict[str, DataFrame]:
        batch.select(*ENVELOPE).write.mode("overwrite").partitionBy("family").parquet(place)
        kept = self.spark.read.schema("record string, family string").parquet(place)
        return {f: kept.where(F.col("family") == f).select(F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*") for f, (_, schema) in FAMILIES.items()}

    def __call__(self, batch: DataFrame, number: int) -> None:
        name, refused, incoming = f"run-{number:09d}", f"refused-{number:09d}.json", f".incoming-{number:09d}"
        if self.files.exists(name) or self.files.exists(refused):
            return
        place = f"{self.files.root}/{incoming}"
        observed = self._saved(batch, place)
        before = [n for n in self.numbers() if n < number]
        facts = fingerprint(self.spark.read.parquet(place), ENVELOPE).first().asDict()
        digest = hashlib.sha256(canonical_bytes({"run_id": name, "records": facts, "policy_sha256": self.policy.sha256})).hexdigest()
        try:
            tables = engine.run(self.spark, admitted(observed, self.policy), self.policy, digest, self.tables(before[-1]) if before else None)
            write_bundle(self.spark, tables, f"{self.files.root}/{name}", {"run_id": name, "manifest_sha256": digest})
        except Refused as why:
            self.files.put(refused, canonical_bytes({"run_id": name, "manifest_sha256": digest, "reason": str(why)}))
        self.files.drop(incoming)


def follow(families: Mapping[str, DataFrame], root: str, policy: Policy, **trigger) -> StreamingQuery:
    """Start the chain over streams of families; progress is kept below the root. trigger: as of writeStream.trigger."""
    stream = envelopes(families)
    runs = Runs(stream.sparkSession, root, policy)
    return stream.writeStream.foreachBatch(runs).option("checkpointLocation", f"{runs.files.root}/.progress").trigger(**(trigger or {"availableNow": True})).start()
