"""True line numbers of text files that Spark reads in blocks, and the occurrences of records by (file, line).

A file's blocks are read by different tasks, each in order. Every line is first written with its block
and its place in the reading task, which hold for this one reading; blocks are then counted, the
counts of a file's earlier blocks added up, and each block's lines shifted by that sum. The only
ordered steps are windows over a file's blocks (128 MB each by default) and over the files of a
range of paths, one short row each.

Defined results: lines end with LF; an empty file has no lines; the last line counts with or without
its LF; of a file that is named twice each line counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.sources.scratch import deleted, written


def numbered(spark: SparkSession, paths: list[str], **keep: Column) -> DataFrame:
    """path, line (from 1), position (from 1, over all files in the order of their paths) and the columns in keep, which
    are expressions over ``value``. Only these are written, so keep less than whole lines where that will do."""
    plain = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    read = spark.read.options(lineSep="\n").text(sorted(set(paths)))
    block = F.col("_metadata.file_block_start")
    kept = written(read.select(plain.alias("path"), block.alias("block"), F.monotonically_increasing_id().alias("place"), *(v.alias(k) for k, v in keep.items())), "lines")
    counted = kept.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    per_file = counted.groupBy("path").agg(F.sum("n").alias("in_file"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counted.withColumn("skip", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    # Files are summed by ranges of their paths; only one number a range, as many as shuffle partitions, meets the driver.
    ranged = written(per_file.repartitionByRange("path").withColumn("part", F.spark_partition_id()), "files")
    sums, total = {}, 0
    for r in ranged.groupBy("part").agg(F.sum("in_file").alias("n")).orderBy("part").collect():
        sums[r.part] = total
        total += r.n
    start = F.element_at(F.create_map(*(F.lit(x).cast("bigint") for pair in sums.items() for x in pair)), F.col("part").cast("bigint")) if sums else F.lit(0)
    before = Window.partitionBy("part").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.withColumn("files_before", F.coalesce(F.sum("in_file").over(before), F.lit(0)) + start).select("path", "files_before")
    # A table of its own, so that its size is known before the join: as long as it is small, lines aren't shuffled to meet it.
    shown = written(shift.join(offsets, "path").select("path", "block", (F.col("skip") + 1).alias("to_line"), (F.col("skip") + F.col("files_before") + 1).alias("to_position")), "blocks")
    out = written(kept.join(shown, ["path", "block"]).select("path", (F.col("place") + F.col("to_line")).alias("line"), (F.col("place") + F.col("to_position")).alias("position"), *keep), "numbered")
    deleted(kept, ranged, shown)
    return out


def occurrences(rows: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """Numbered records with occurrence (1 for the first of an identity by path, then line) and replayed."""
    seen = F.row_number().over(Window.partitionBy(*identity).orderBy("position"))
    return rows.withColumn("occurrence", seen).withColumn("replayed", F.col("occurrence") > 1)
