"""Physical verification of Parquet files as a join: what a manifest's inventory says against what is there.

Sizes and digests come from the files' bytes, row counts and column types from their footers; both
sides are tables and meet in one full outer join, so no list of files reaches the driver.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions.columns import reasons

FACTS = "path string, size_bytes long, sha256 string, n_rows long, columns string"
#: A footer that doesn't fit is reported as unreadable.
MOST_FOOTER = 4 << 20


def plain_path(folder: str) -> str:
    """A folder's path as a pattern, whatever its scheme is written like."""
    return re.escape(re.sub("^[a-z0-9]+:/+", "/", folder.rstrip("/")))


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Row count and 'name type' pairs from the ends of Parquet files; null for what is no Parquet file."""
    import pyarrow.parquet as pq

    def read(tail: bytes) -> tuple[int | None, str | None]:
        try:  # only the end is looked at, so the head of the file may be missing
            footer = pq.read_metadata(io.BytesIO(b"PAR1" + tail))
            return footer.num_rows, ", ".join(f"{f.name} {f.type}" for f in footer.schema.to_arrow_schema())
        except Exception:  # noqa: BLE001  any damage is one finding
            return None, None

    for batch in batches:
        found = [read(bytes(t)) for t in batch["tail"]]
        yield pd.DataFrame({"path": batch["path"], "size_bytes": batch["size_bytes"], "sha256": batch["sha256"], "n_rows": pd.array([n for n, _ in found], dtype="Int64"), "columns": [c for _, c in found]})


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """path (below folder), size_bytes, sha256, n_rows and columns of every data file; bytes stay on the executors."""
    raw = spark.read.format("binaryFile").options(recursiveFileLookup="true").load(folder)
    inside = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/+", "/"), f"^{plain_path(folder)}/", "")
    tail = F.substring("content", F.greatest(F.lit(1), F.col("length").cast("int") - MOST_FOOTER + 1), F.lit(MOST_FOOTER))
    return raw.select(inside.alias("path"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), tail.alias("tail")).mapInPandas(_footers, FACTS)


def physical_faults(declared: DataFrame, found: DataFrame) -> DataFrame:
    """path, fault of every file that differs: MISSING, EXTRA, else any of SIZE, DIGEST, ROWS and COLUMNS.

    Both sides have the columns of ``facts``; a path that is declared twice is REPEATED. Empty sides are
    allowed. COLUMNS also holds where a footer can't be read.
    """
    side = lambda df, name: df.groupBy("path").agg(F.any_value(F.struct("size_bytes", "sha256", "n_rows", "columns")).alias(name), F.count("*").alias(f"n_{name}"))
    both = side(declared, "d").join(side(found, "f"), "path", "full_outer")
    either = {name: ~F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for name, c in (("SIZE", "size_bytes"), ("DIGEST", "sha256"), ("ROWS", "n_rows"))}
    either["COLUMNS"] = ~F.col("d.columns").eqNullSafe(F.col("f.columns")) | F.col("f.columns").isNull()
    faults = F.when(F.col("f").isNull(), F.array(F.lit("MISSING"))).when(F.col("d").isNull(), F.array(F.lit("EXTRA"))).otherwise(reasons(either | {"REPEATED": F.col("n_d") > 1}))
    return both.select("path", F.explode(faults).alias("fault"))
