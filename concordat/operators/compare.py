"""Fingerprints, summaries, control totals and set comparison of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.columns import canonical_json


def fingerprint(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Order-free: row count, least and greatest row digest, and sums of the digest's 48-bit pieces."""
    rows = df.select(F.sha2(canonical_json({c: c for c in columns}), 256).alias("d"))
    pieces = [F.sum(F.conv(F.substring("d", 12 * i + 1, 12), 16, 10).cast("decimal(38,0)")).cast("string").alias(f"sum_{i}") for i in range(5)]
    return rows.agg(F.count("*").alias("n_rows"), F.min("d").alias("least"), F.max("d").alias("greatest"), *pieces)


def summary(df: DataFrame, groups: tuple[str, ...], amounts: tuple[str, ...]) -> DataFrame:
    """Counts and exact totals as text by group."""
    totals = [F.sum(F.col(a).cast("decimal(38,0)")).cast("string").alias(a) for a in amounts]
    return df.groupBy(*groups).agg(F.count("*").alias("n_rows"), *totals)


def differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted, with the side that has them."""
    names = expected.columns
    tagged = expected.withColumn("e", F.lit(1)).unionByName(actual.select(*names).withColumn("e", F.lit(-1)))
    return tagged.groupBy(*names).agg(F.sum("e").alias("balance")).where("balance <> 0").withColumn("side", F.when(F.col("balance") > 0, "expected").otherwise("actual"))


def verdict(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """batch_status and reason_codes of a run: all reasons of all rows, in the policy's order."""
    seen = rows.where("reason_codes <> ''").select(F.explode(F.split("reason_codes", r"\|")).alias("code")).distinct().agg(F.collect_set("code").alias("codes"))
    listed = F.array_intersect(F.array(*map(F.lit, order)), "codes")
    status = F.when(F.size(listed) > 0, "EXCEPTION").when(F.array_contains("codes", "TOLERATED_DIFFERENCE"), "WITHIN_TOLERANCE").otherwise("MATCHED")
    codes = F.when((F.size(listed) == 0) & F.array_contains("codes", "TOLERATED_DIFFERENCE"), "TOLERATED_DIFFERENCE").otherwise(F.array_join(listed, "|"))
    return seen.select(status.alias("batch_status"), codes.alias("reason_codes"))


def repeated(rows: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """Identities that a table holds more than once; comparisons refuse such tables."""
    return rows.groupBy(*identity).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
