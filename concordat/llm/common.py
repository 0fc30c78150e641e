"""What the corpus operators share: the cluster's shared folder and materialised steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a temporary one of this process, which
    only a local master can share with its executors; other masters are refused."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is unset and {master} shares no local folder")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="concordat-")
    return _own[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there and every
    executor sees the files, so a lost executor costs only its running tasks."""
    return Steps(df.sparkSession).save(df, name)


class Steps:
    """The materialised steps of one computation, deleted as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._saved: dict[int, tuple[DataFrame, str]] = {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        df.write.parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        self._saved[id(saved)] = saved, path
        return saved

    def drop(self, *frames: DataFrame) -> None:
        """Delete the files of saved frames; frames that were not saved here are left alone."""
        for df in frames:
            if own := self._saved.pop(id(df), None):
                place = self.spark._jvm.org.apache.hadoop.fs.Path(own[1])
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
