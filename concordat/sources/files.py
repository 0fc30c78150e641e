"""Source objects as files: record formats, locators, byte identity, framing and strict JSON.

All checks are violation rows (rule, family, identity, detail), found before any record is used; see
``admit_bundle``. A JSON Lines or CSV record is one line ended by LF. Digests come from Spark's
binary file source, so one object holds less than 2 GB; larger families are several objects.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator, Mapping
from pathlib import Path, PurePosixPath
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions.columns import plain_ascii
from concordat.operators.admission import VIOLATION, Refused, admit, admitted, violations
from concordat.operators.policy import Policy, check_manifest
from concordat.sources.scratch import deleted, written

# Families, their formats and their fields in file order.
_POSTINGS = "array<struct<line_id:string,account_role:string,side:string,amount_minor:bigint>>"
FAMILIES: dict[str, tuple[str, str]] = {
    "PROCESSOR_EVENTS": ("json", """schema_version string, source_record_id string, source_batch_id string, processor string, merchant_id string, payment_id string,
        event_type string, amount_minor bigint, currency string, occurred_at string, received_at string, reference_event_id string, payload_sha256 string"""),
    "PROCESSOR_SETTLEMENTS": ("csv", """schema_version string, source_record_id string, source_batch_id string, processor string, merchant_id string, settlement_id string,
        settlement_cycle string, currency string, gross_minor bigint, fee_minor bigint, refund_minor bigint, chargeback_minor bigint, reserve_minor bigint,
        reported_net_minor bigint, occurred_at string, received_at string, payload_sha256 string"""),
    "LEDGER_JOURNALS": ("json", f"""schema_version string, journal_id string, source_batch_id string, ledger_system string, processor string, merchant_id string, payment_id string,
        settlement_id string, settlement_cycle string, entry_type string, currency string, effective_at string, received_at string, postings {_POSTINGS}, payload_sha256 string"""),
    "BANK_ENTRIES": ("csv", """schema_version string, bank_record_id string, source_batch_id string, bank_account_id string, merchant_id string, settlement_reference string,
        direction string, amount_minor bigint, currency string, value_at string, received_at string, payload_sha256 string"""),
}
IDENTITY, SCHEMA = "SOURCE_IDENTITY_MISMATCH", "SCHEMA_VIOLATION"
INT64 = range(-(1 << 63), 1 << 63)


def read_family(spark: SparkSession, paths: list[str], family: str) -> DataFrame:
    """The records of a family's objects; a malformed record fails the job."""
    form, schema = FAMILIES[family]
    reader = spark.read.schema(schema).options(mode="FAILFAST", encoding="UTF-8", lineSep="\n")
    if form == "json":
        return reader.options(multiLine="false").json(paths)
    return reader.options(header="true", enforceSchema="false", quote='"', escape='"', nullValue="", emptyValue="").csv(paths)


def locator(item: Mapping[str, Any]) -> str:
    """One text that names an object of a manifest, version included."""
    kind = item.get("locator_type")
    fields = {"LOCAL_FILE": ("relative_path",), "S3_OBJECT": ("s3_uri", "version_id")}.get(kind, ())
    if not fields or not all(isinstance(item.get(f), str) for f in fields):
        raise ValueError(f"{IDENTITY}: incomplete locator of type {kind}")
    return {"LOCAL_FILE": "local:", "S3_OBJECT": "s3:"}[kind] + "#".join(item[f] for f in fields)


def confined(root: str | Path, relative: str) -> str:
    """Absolute path of a regular file below root; absolute names, ``..`` and links are refused."""
    name, base = PurePosixPath(relative), Path(root).resolve()
    steps = [base.joinpath(*name.parts[: i + 1]) for i in range(len(name.parts))]
    if name.is_absolute() or ".." in name.parts or any(s.is_symlink() for s in steps) or not steps or not steps[-1].is_file():
        raise ValueError(f"{IDENTITY}: {relative} is no plain file below the input folder")
    return str(steps[-1])


def _plain(path):
    return F.regexp_replace(path, "^file:/+", "/")


def identities(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, size_bytes, sha256 and marked (it starts with a byte order mark) of every object."""
    raw = spark.read.format("binaryFile").load(paths)
    return raw.select(_plain(F.col("path")).alias("path"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), (F.hex(F.substring("content", 1, 3)) == "EFBBBF").alias("marked"))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.options(lineSep="\n").text(paths).select(_plain(F.col("_metadata.file_path")).alias("path"), "value")


def framing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, n_lines, n_empty, n_cr and n_invalid (not UTF-8) of every object with a line: one scan, partial sums."""
    count = lambda test: F.count_if(test)
    return _lines(spark, paths).groupBy("path").agg(
        F.count("*").alias("n_lines"), count(F.col("value") == "").alias("n_empty"), count(F.contains("value", F.lit("\r"))).alias("n_cr"), count(~F.is_valid_utf8("value")).alias("n_invalid"),
    )


def strict_fault(text: str) -> str | None:
    """Why a line isn't a strict JSON object, or None: integers of 64 bits only, names that stay distinct under NFC."""

    def fail(why: str):
        raise ValueError(why)

    def whole(digits: str) -> int:
        return int(digits) if len(digits) < 21 and int(digits) in INT64 else fail("INTEGER_RANGE")

    def named(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
        found = {unicodedata.normalize("NFC", k): v for k, v in pairs}
        return found if len(found) == len(pairs) else fail("REPEATED_NAME")

    try:
        value = json.loads(text, parse_float=lambda _: fail("NOT_AN_INTEGER"), parse_constant=lambda _: fail("NOT_A_NUMBER"), parse_int=whole, object_pairs_hook=named)
    except json.JSONDecodeError:
        return "MALFORMED"
    except (ValueError, RecursionError) as error:
        return "TOO_DEEP" if isinstance(error, RecursionError) else str(error)
    return None if isinstance(value, dict) else "NOT_AN_OBJECT"


def _parsed(value: Column) -> Column:
    """The line as VARIANT if it is exactly one JSON text without repeated names, else null.

    What follows the first text would be ignored, so the line is parsed inside an array that ends with its own digest.
    """
    mark = F.sha2(value, 256)
    whole = F.try_parse_json(F.concat(F.lit("["), value, F.lit(',"'), mark, F.lit('"]')))
    return F.when(F.try_variant_get(whole, "$[1]", "string") == mark, F.try_variant_get(whole, "$[0]", "variant"))


def plainly_strict(value: Column) -> Column:
    """True for lines that are strict JSON objects beyond doubt, decided in the JVM: one object, names in ASCII,
    numbers all of 64-bit integers. False for all others, strict or not."""
    shape = F.schema_of_variant(_parsed(value))
    return F.coalesce(F.startswith(shape, F.lit("OBJECT<")) & plain_ascii(shape) & ~shape.rlike("DECIMAL|DOUBLE|FLOAT|VARIANT"), F.lit(False))


def strict_faults(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, fault of every line that isn't strict JSON. Lines that the JVM isn't sure of go to the Python parser, in
    Arrow batches; where there are none, the result has no Python in its plan."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fault = batch["value"].map(strict_fault)
            yield pd.DataFrame({"path": batch["path"], "fault": fault})[fault.notna()]

    readable = _lines(spark, paths).where(F.is_valid_utf8("value") & (F.col("value") != ""))
    doubtful = readable.where(~plainly_strict(F.col("value")))
    if doubtful.isEmpty():
        return spark.createDataFrame([], "path string, fault string")
    return doubtful.mapInPandas(run, "path string, fault string")


def unknown_fields(spark: SparkSession, declared: Iterable[tuple[str, str]]) -> DataFrame:
    """path, fault of JSON lines with a field that their family doesn't have, or a posting's that postings don't; declared: (family, path).

    Reading by a schema would drop such fields without a word.
    """
    found = spark.createDataFrame([], "path string, fault string")
    for family in sorted({f for f, _ in declared}):
        schema = T.StructType.fromDDL(FAMILIES[family][1])
        value = F.col("value")
        unknown = F.array_except(F.json_object_keys(value), F.array(*map(F.lit, schema.names)))
        if "postings" in schema.names:
            inner = F.from_json(F.get_json_object(value, "$.postings"), "array<map<string,string>>")
            keys = F.array_distinct(F.flatten(F.transform(inner, F.map_keys)))
            unknown = F.concat(unknown, F.coalesce(F.array_except(keys, F.array(*map(F.lit, schema["postings"].dataType.elementType.names))), F.array().cast("array<string>")))
        lines = _lines(spark, [p for f, p in declared if f == family]).where(F.is_valid_utf8("value") & F.startswith(F.trim("value"), F.lit("{")))
        found = found.unionByName(lines.where(F.size(unknown) > 0).select("path", F.concat(F.lit("UNKNOWN_FIELD "), F.array_min(unknown)).alias("fault")))
    return found


def canonical_faults(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, fault of the lines that aren't their own canonical form: sorted names, no blanks, no needless escapes."""
    lines = _lines(spark, paths).where(F.is_valid_utf8("value") & (F.col("value") != ""))
    return lines.where(~F.col("value").eqNullSafe(F.to_json(_parsed(F.col("value"))))).select("path", F.lit("NOT_CANONICAL").alias("fault"))


def object_violations(spark: SparkSession, declared: Iterable[Mapping[str, Any]], canonical: bool = False) -> DataFrame:
    """Violations of objects (family, path, size_bytes, sha256, record_count) by their bytes and lines; canonical
    asks for JSON lines in canonical form too.

    An object without records is one LF (JSON Lines) or the header alone (CSV).
    """
    named = [(d["family"], FAMILIES[d["family"]][0], d["path"], d["size_bytes"], d["sha256"], d["record_count"]) for d in declared]
    paths = [n[2] for n in named]
    json_paths = [n[2] for n in named if n[1] == "json"]
    frame = spark.createDataFrame(named, "family string, form string, path string, size long, digest string, records long")
    # Both sides have a row for each object of the manifest.
    facts = frame.join(identities(spark, paths), "path", "left").join(framing(spark, paths), "path", "left")
    lines = F.coalesce("n_lines", F.lit(0))
    bare = (F.col("form") == "json") & (F.col("records") == 0) & (F.col("size_bytes") == 1) & (F.col("n_empty") == 1)
    have = F.when(bare, 0).when(F.col("form") == "json", lines).otherwise(lines - 1)
    rules = [
        (IDENTITY, "size", ~F.col("size_bytes").eqNullSafe(F.col("size"))),
        (IDENTITY, "digest", ~F.col("sha256").eqNullSafe(F.col("digest"))),
        (IDENTITY, "record count", have != F.col("records")),
        (SCHEMA, "byte order mark", F.col("marked")),
        (SCHEMA, "carriage return", F.col("n_cr") > 0),
        (SCHEMA, "invalid UTF-8", F.col("n_invalid") > 0),
        (SCHEMA, "empty record", (F.col("n_empty") > 0) & ~bare),
    ]
    found = F.array_compact(F.array(*(F.when(test, F.struct(F.lit(rule).alias("rule"), F.lit(detail).alias("detail"))) for rule, detail, test in rules)))
    wrong = facts.select("family", "path", F.explode(found).alias("v")).select("v.rule", "family", F.col("path").alias("identity"), "v.detail").select(*VIOLATION)
    if not json_paths:
        return wrong
    faults = strict_faults(spark, json_paths).unionByName(unknown_fields(spark, [(n[0], n[2]) for n in named if n[1] == "json"]))
    if canonical:
        faults = faults.unionByName(canonical_faults(spark, json_paths))
    loose = faults.groupBy("path").agg(F.min("fault").alias("detail")).join(frame, "path")
    return violations(wrong, loose.select(F.lit(SCHEMA).alias("rule"), "family", F.col("path").alias("identity"), "detail"))


def admit_bundle(spark: SparkSession, manifest: Mapping[str, Any], root: str | Path, policy: Policy, known_runs: Mapping[str, str] | None = None, canonical: bool = False) -> dict[str, DataFrame]:
    """The families of a manifest, after the manifest, every object and every record passed.

    Refused: a manifest that isn't what it says or names another policy, repeated locators, families
    that are missing or unknown, objects that differ in size, digest, record count or framing, JSON
    that isn't strict (or, on demand, not in canonical form), and all that ``admission.gates`` finds.
    Records are parsed once, into columnar tables in the shared folder, which gates and results read; see ``release``. Replays are dropped. Nothing is
    returned or written before that.
    """
    check_manifest(manifest, policy, known_runs)
    objects = list(manifest.get("objects", ()))
    names = [locator(o) for o in objects]
    if len(set(names)) < len(names):
        raise ValueError(f"{IDENTITY}: repeated locator")
    if {o.get("family") for o in objects} != set(FAMILIES):
        raise ValueError(f"{SCHEMA}: families must be {sorted(FAMILIES)}")
    placed = [dict(o) | {"path": confined(root, o["relative_path"]) if o["locator_type"] == "LOCAL_FILE" else o["s3_uri"]} for o in objects]
    admit(object_violations(spark, placed, canonical))
    parsed = {f: written(read_family(spark, [o["path"] for o in placed if o["family"] == f], f), f.lower().replace("_", "-")) for f in FAMILIES}
    try:
        return admitted(parsed, policy)
    except Refused:
        deleted(*parsed.values())
        raise


def release(found: Mapping[str, DataFrame]) -> None:
    """Delete the parsed records of an admitted bundle, after their last reader."""
    deleted(*found.values())
