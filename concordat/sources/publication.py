"""Results as bundles of Parquet tables, and the log of bundles that were made authoritative.

A bundle is written under a hidden name; an inventory table (every file's size, digest, row count and
columns) and the manifest (counts and order-free fingerprints of all tables, the inventory's too)
follow, then the completion marker, then one rename. A log entry is a numbered
file that can be created once: of two writers that saw the same head one fails. All files are
reached through Hadoop's file systems. On stores whose rename isn't atomic (and between the check
and the rename of the local one), writers of one log need a lock of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators import history, revisions
from concordat.operators.compare import fingerprint
from concordat.sources.verification import FACTS, facts, physical_faults, plain_path

MANIFEST, COMPLETED, INVENTORY = "candidate-manifest.json", "COMPLETED.json", "inventory"


def canonical_bytes(value: Any) -> bytes:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode() + b"\n"


class Files:
    """Small documents and renames in the store that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        conf = spark._jsc.hadoopConfiguration()
        path = self._jvm.org.apache.hadoop.fs.Path(root)
        self.system = path.getFileSystem(conf)
        self.root = self.system.makeQualified(path).toString().rstrip("/")
        self.context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path().toUri(), conf)

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.system.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self.system.listStatus(self._path(name))) if self.exists(name) else []

    def read(self, name: str) -> bytes:
        stream = self.system.open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def move(self, old: str, new: str) -> None:
        """Rename; an existing target is refused."""
        none = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        self.system.mkdirs(self._path(new).getParent())
        try:
            self.context.rename(self._path(old), self._path(new), none)
        except Py4JJavaError as error:
            raise FileExistsError(f"{self.root}/{new}: {error.java_exception.getMessage()}") from error

    def put(self, name: str, raw: bytes) -> str:
        """Write a document whole or not at all, never over another one; returns its SHA-256."""
        folder, _, leaf = name.rpartition("/")
        partial = f"{folder}/.{leaf}.partial".lstrip("/")
        stream = self.system.create(self._path(partial), True)
        stream.write(bytearray(raw))
        stream.close()
        self.move(partial, name)
        return hashlib.sha256(raw).hexdigest()

    def drop(self, name: str) -> None:
        self.system.delete(self._path(name), True)


def write_bundle(spark: SparkSession, frames: Mapping[str, DataFrame], destination: str, run: Mapping[str, str]) -> str:
    """Publish frames at destination, which mustn't exist; returns the manifest's SHA-256.

    What an earlier attempt left under the hidden name is written anew.
    """
    parent, _, name = destination.rstrip("/").rpartition("/")
    files = Files(spark, parent)
    if files.exists(name):
        raise FileExistsError(destination)
    partial = f".{name}.partial"
    files.drop(partial)
    place = f"{files.root}/{partial}"
    tables = {}
    for table, frame in frames.items():
        frame.write.mode("errorifexists").parquet(f"{place}/{table}")
        tables[table] = _logical(spark.read.parquet(f"{place}/{table}"))
    logical = hashlib.sha256(canonical_bytes(tables)).hexdigest()
    facts(spark, place).write.parquet(f"{place}/{INVENTORY}")
    listed = _logical(spark.read.schema(FACTS).parquet(f"{place}/{INVENTORY}"))
    manifest = {"run": dict(run), "tables": tables, "logical_sha256": logical, "inventory": listed}
    digest = files.put(f"{partial}/{MANIFEST}", canonical_bytes(manifest))
    files.put(f"{partial}/{COMPLETED}", canonical_bytes({"manifest_sha256": digest, "logical_sha256": logical, "authoritative_proof": False}))
    files.move(partial, name)
    return digest


def _logical(frame: DataFrame) -> dict[str, Any]:
    return fingerprint(frame, tuple(sorted(frame.columns))).first().asDict()


def open_bundle(spark: SparkSession, destination: str, manifest_sha256: str | None = None) -> dict[str, DataFrame]:
    """The tables of a complete bundle, after its documents and every file agree with their digests."""
    files = Files(spark, destination.rstrip("/"))
    if not files.exists(COMPLETED):
        raise ValueError(f"{destination} is not complete")
    raw = files.read(MANIFEST)
    digest = hashlib.sha256(raw).hexdigest()
    if digest != json.loads(files.read(COMPLETED))["manifest_sha256"] or manifest_sha256 not in (None, digest):
        raise ValueError(f"{destination}: the manifest was changed")
    manifest = json.loads(raw)
    declared = spark.read.schema(FACTS).parquet(f"{files.root}/{INVENTORY}")
    if _logical(declared) != manifest["inventory"]:
        raise ValueError(f"{destination}: the inventory differs from the manifest")
    now = facts(spark, files.root).where(~F.startswith("path", F.lit(INVENTORY + "/")) & ~F.col("path").isin(MANIFEST, COMPLETED))
    if wrong := physical_faults(declared, now).orderBy("path", "fault").take(1):
        raise ValueError(f"{destination}: files differ from the manifest: {wrong[0].fault} {wrong[0].path}")
    return {t: spark.read.parquet(f"{files.root}/{t}") for t in manifest["tables"]}


def write_shards(df: DataFrame, destination: str, form: str, rows_per_shard: int, order: tuple[str, ...]) -> list[dict[str, Any]]:
    """df in that order as JSON Lines or CSV files of at most so many rows; returns their inventory with
    each file's first and last index (from 0) in the whole.

    Rows are ordered by ranges, and a file's rows follow one another in its range, so indices come
    from the files' own line counts.
    """
    spark = df.sparkSession
    writer = df.orderBy(*order).write.mode("errorifexists").option("maxRecordsPerFile", rows_per_shard).option("lineSep", "\n")
    header = 0 if form == "json" else 1
    if form == "json":
        writer.json(destination)
    else:
        writer.options(header="true", quote='"', escape='"', emptyValue="").csv(destination)
    root = Files(spark, destination).root
    inside = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^[a-z0-9]+:/+", "/"), f"^{plain_path(root)}/", "")
    lines = {r.path: r.n - header for r in spark.read.options(lineSep="\n").text(root).groupBy(inside.alias("path")).agg(F.count("*").alias("n")).collect()}
    at, out = 0, []
    listed = (r.asDict() for r in facts(spark, root).select("path", "size_bytes", "sha256").collect())
    for item in sorted(listed, key=lambda r: r["path"]):
        n = lines.get(item["path"], 0)
        out.append(item | {"first_index": at, "last_index": at + n - 1})
        at += n
    return out


def write_registered(spark: SparkSession, df: DataFrame, root: str, run_id: str, attempt_id: str) -> str:
    """Add one attempt's rows to a table partitioned by run and attempt; each partition is written once."""
    place = f"run_id={run_id}/attempt_id={attempt_id}"
    files = Files(spark, root)
    if files.exists(place):
        raise FileExistsError(f"{root}/{place}")
    df.write.mode("errorifexists").parquet(f"{files.root}/{place}")
    return f"{files.root}/{place}"


def read_registered(spark: SparkSession, root: str, run_id: str, attempt_id: str, schema: str | None = None) -> DataFrame:
    """One attempt's rows; the filter reaches the scan, which lists only that partition."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(root).where((F.col("run_id") == run_id) & (F.col("attempt_id") == attempt_id))


class History:
    """The authoritative log: entries ``log/000000001.json`` ... , each naming its predecessor's digest and a bundle."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)

    def entries(self) -> list[dict[str, Any]]:
        """All entries in order, with their digests; a gap, a changed entry or a broken link is refused."""
        found, parent = [], None
        for at, name in enumerate((n for n in self.files.names("log") if n.endswith(".json") and n[0] != "."), 1):
            raw = self.files.read(f"log/{name}")
            entry = json.loads(raw)
            if name != f"{at:09d}.json" or entry["number"] != at or entry["parent_sha256"] != parent or canonical_bytes(entry) != raw:
                raise ValueError(f"log entry {name} does not continue its predecessor")
            parent = hashlib.sha256(raw).hexdigest()
            found.append(entry | {"sha256": parent})
        return found

    def head(self) -> str | None:
        found = self.entries()
        return found[-1]["sha256"] if found else None

    def attempt(self, attempt_id: str) -> dict[str, Any] | None:
        return next((e for e in self.entries() if e["attempt_id"] == attempt_id), None)

    def finalize(self, attempt_id: str, frames: Mapping[str, DataFrame], run: Mapping[str, str], expected_head: str | None) -> dict[str, Any]:
        """Append a bundle if the head is still the expected one. A finished attempt gives its entry again;
        an attempt that ended between bundle and entry goes on with the bundle it wrote."""
        known = self.entries()
        if done := next((e for e in known if e["attempt_id"] == attempt_id), None):
            return done
        if (known[-1]["sha256"] if known else None) != expected_head:
            raise ValueError("the head has moved")
        bundle = f"bundles/{attempt_id}"
        if not self.files.exists(bundle):
            self.files.system.mkdirs(self.files._path("bundles"))
            write_bundle(self.spark, frames, f"{self.files.root}/{bundle}", run)
        manifest = self.files.read(f"{bundle}/{MANIFEST}")
        if json.loads(manifest)["run"] != dict(run):
            raise ValueError(f"attempt {attempt_id} wrote a bundle of another run")
        entry = {"number": len(known) + 1, "parent_sha256": expected_head, "attempt_id": attempt_id, "bundle": bundle, "run": dict(run), "manifest_sha256": hashlib.sha256(manifest).hexdigest()}
        raw = canonical_bytes(entry)
        return entry | {"sha256": self.files.put(f"log/{entry['number']:09d}.json", raw)}

    def state(self) -> dict[str, DataFrame]:
        """The tables of the newest entry, verified."""
        found = self.entries()
        if not found:
            raise ValueError("the log is empty")
        return open_bundle(self.spark, f"{self.files.root}/{found[-1]['bundle']}", found[-1]["manifest_sha256"])

    def runs(self) -> dict[str, str]:
        """Manifest digests by run id of all entries."""
        return {e["run"]["run_id"]: e["run"]["manifest_sha256"] for e in self.entries() if "manifest_sha256" in e.get("run", {})}

    def chained(self, table: str, entries: list[dict[str, Any]]) -> DataFrame:
        """A table's rows of all entries, with the entry's number as run: one scan."""
        paths = {f"{self.files.root}/{e['bundle']}/{table}": e["number"] for e in entries}
        numbers = self.spark.createDataFrame([(re.sub("^[a-z0-9]+:/+", "/", p), n) for p, n in paths.items()], "place string, run int")
        place = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^[a-z0-9]+:/+", "/"), "/[^/]*$", "")
        return self.spark.read.parquet(*paths).withColumn("place", place).join(numbers, "place").drop("place")

    def faults(self, entries: list[dict[str, Any]]) -> DataFrame:
        """``history.chain_faults`` of the revisions of all entries, which must hold proofs, cases and both result tables."""
        proofs, cases = self.chained("proofs", entries), self.chained("cases", entries)
        flat = lambda t: t.select("run", "reconciliation_key", "status", F.array_join("reason_codes", "|").alias("reason_codes"), "totals.difference_minor")
        both = flat(self.chained("transactions", entries)).unionByName(flat(self.chained("settlements", entries)))
        return history.chain_faults(proofs, both, cases, len(entries), cases.where(F.col("case_status") == revisions.CORRECTED))

    def verify(self) -> int:
        """Check every entry, every bundle's files, and, from the tables of all entries in one plan, that each proof, result
        and case is what those before it give; returns the number of entries.

        A case that is resolved by correction is checked but for the correction itself, which is not kept.
        """
        found = self.entries()
        held = [open_bundle(self.spark, f"{self.files.root}/{e['bundle']}", e["manifest_sha256"]).keys() for e in found]
        if found and all({"proofs", "cases", "transactions", "settlements"} <= set(h) for h in held):
            if wrong := self.faults(found).orderBy("run", "reconciliation_key", "fault").take(1):
                raise ValueError(f"{found[wrong[0].run - 1]['bundle']}: {wrong[0].fault} of {wrong[0].reconciliation_key}")
        return len(found)
