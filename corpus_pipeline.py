"""A corpus from documents: quality rules, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is
written as Parquet and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from concordat.llm import common, stages
from concordat.sources.tables import table

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("secret_scans", stages.secret_scans),
    ("best_fit_packing", stages.best_fit_packing),
]

#: Learned cutoffs, the forest and token counts have no SQL form; tests/llm compares every stage and the whole with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = common.Steps(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, steps.save(stage(spark, docs, sf_dir), name)
        steps.drop(before)
    return docs
