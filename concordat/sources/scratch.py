"""Intermediate tables in the folder that the cluster shares (spark.checkpoint.dir): lineage ends in them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which the shuffle files of a query go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; only a local master may do without it."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("EXECUTION_ENVIRONMENT: spark.checkpoint.dir is unset")
    return _local.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="concordat-"))


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside has its shuffle files deleted once it stands."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table of its own below the shared folder; what was shuffled for it is deleted once it stands."""
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with freed(spark):
        df.write.parquet(place, compression="zstd")
    return spark.read.schema(df.schema).parquet(place)


def deleted(*tables: DataFrame) -> None:
    """Delete the files of written tables, after their last reader."""
    for df in tables:
        for place in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
