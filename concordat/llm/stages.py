"""The corpus pipeline's stages: each keeps or changes documents and returns their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import packing, quality, queries, secrets, similarity
from concordat.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Cutoffs come from all labels of documents given.

    Rows are matched to verdicts by doc_id and text hash, so rows that share a doc_id are judged
    each by its own text; equal rows have equal verdicts. Null, empty and short texts fail the base rule
    and go; a null language is a stratum of its own; labels that are null, repeated or of no document
    count once or not at all; texts of any length are judged whole; an empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    verdicts = quality.judge(_keyed(docs), table(spark, sf_dir, "labels"), carry=("text_key",))
    rejected = verdicts.where(~F.col("kept")).select("doc_id", "text_key").distinct()
    left, right = _keyed(docs).alias("d"), rejected.alias("r")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_key") == F.col("r.text_key"))
    return left.join(right, same, "left_anti").select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit(""))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    The smallest doc_id of a group stays. Null, empty and wordless texts and rows without doc_id have no
    duplicates and all stay; of equal rows one stays; rows that share a doc_id are one node, of which the
    smallest text stays. Texts of any length are compared whole; an empty table stays empty; columns
    other than those of documents are dropped.
    """
    return similarity.first_of_each(docs.select(*COLUMNS), k=5, num=4, den=5)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted anew.

    Null texts stay null (and their n_chars null), empty ones empty; repeated rows and rows without
    doc_id are scanned each for itself; texts of any length are scanned whole; an empty table stays empty.
    """
    return secrets.redact(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences and places.

    Null and empty texts are one piece of the separator alone; only documents over 2048 tokens are cut;
    repeated rows and rows without doc_id are packed each; pieces of one length are told apart by their
    other columns, and equal pieces may change places. An empty table gives no pieces.
    """
    return packing.pack_documents(docs.select(*COLUMNS), queries.vocabulary())
