"""Session settings the engine relies on."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

#: The first versions with all that the engine uses: VARIANT, recursive queries and keyed state with timers.
PYTHON, SPARK = (3, 11), (4, 1)
REQUIRED = {"spark.sql.ansi.enabled": "true", "spark.sql.session.timeZone": "UTC"}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("concordat")
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def guard(spark: SparkSession) -> None:
    """Refuse runtimes too old for the engine, and sessions in which money could wrap or times shift (ANSI off, not UTC)."""
    version = tuple(map(int, spark.version.split(".")[:2]))
    if version < SPARK or sys.version_info[:2] < PYTHON:
        raise RuntimeError(f"EXECUTION_ENVIRONMENT: Python {PYTHON} and Spark {SPARK} at least, got {sys.version_info[:2]} and {version}")
    wrong = {k: spark.conf.get(k) for k, v in REQUIRED.items() if spark.conf.get(k) != v}
    if wrong:
        raise RuntimeError(f"EXECUTION_ENVIRONMENT: session must have {REQUIRED}, got {wrong}")
