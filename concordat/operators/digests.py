"""Digest trees over tables, and the differences of two tables by descending them.

A row's place is the SHA-256 of its identity, and a tree's node of level l is the first l hex digits
of a place: sixteen children a node. A leaf's digest is that of its rows' digests in the order of
their places, a node's that of its children's in order. So the root depends on nothing but the rows,
whatever their order or partitions, and no task holds more than one leaf (n / 16^depth rows) or
sixteen children. With all columns as identity the root is an ordered digest of a multiset: equal rows
are counted before they meet, and only their number goes into the leaf.

Two tables are compared from the roots down: children are read only below unequal nodes, and rows
only in unequal leaves. A table that is published with its tree is stored by place, in folders of
the first two digits, so that a comparison reads the two trees and the folders in which they differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions.columns import canonical_json
from concordat.operators.compare import repeated
from concordat.sources.scratch import deleted, written

BLOCK_DIGITS = 2
NODE = ("level", "node", "n_rows", "n_places", "digest")
MOST_DEPTH = 8


def depth_for(n_rows: int, leaf_rows: int = 50_000) -> int:
    """The depth at which a leaf holds about so many rows."""
    depth = 1
    while depth < MOST_DEPTH and n_rows > leaf_rows * 16**depth:
        depth += 1
    return depth


def placed(df: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """df with place and row_sha256."""
    digest = lambda names: F.sha2(canonical_json({c: c for c in names}), 256)
    return df.withColumns({"place": digest(identity), "row_sha256": digest(df.columns)})


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(*parts: Column, n_digests: int = 0) -> Column:
    """Digest of sorted items: each is its parts with blanks between, ended by a line feed; the first n_digests parts are bytes, shown in hex."""
    shown = lambda s: (_hex(s[f"p{i}"]) if i < n_digests else s[f"p{i}"].cast("string") for i in range(len(parts)))
    items = F.transform(F.array_sort(F.collect_list(F.struct(*(p.alias(f"p{i}") for i, p in enumerate(parts))))), lambda s: F.concat(F.concat_ws(" ", *shown(s)), F.lit("\n")))
    return F.sha2(F.array_join(items, ""), 256)


def leaves(rows: DataFrame, depth: int) -> DataFrame:
    """node, n_rows, n_places, digest of the leaves; rows: of ``placed``.

    Each place is first reduced to its number of rows and its least and greatest row digest, so no hot
    identity is gathered. Of tables with at most two different rows an identity nothing is lost. Digests are
    shuffled as bytes, which sort as their hex does: half of what no compression of shuffles makes smaller.
    """
    one = rows.groupBy(F.unhex("place").alias("place")).agg(F.min(F.unhex("row_sha256")).alias("low"), F.max(F.unhex("row_sha256")).alias("high"), F.count("*").alias("n"))
    node = F.substring(_hex(F.substring("place", 1, (depth + 1) // 2)), 1, depth)
    return one.groupBy(node.alias("node")).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_places"), _joined(*map(F.col, ("place", "low", "high", "n")), n_digests=3).alias("digest"))


def tree(leaf: DataFrame, depth: int) -> DataFrame:
    """level and the columns of ``leaves`` for all nodes from the leaves up to the root (level 0, node ''). No leaves: no nodes."""
    now, out = leaf, leaf.select(F.lit(depth).alias("level"), *NODE[1:])
    for level in range(depth - 1, -1, -1):
        totals = [F.sum(c).alias(c) for c in ("n_rows", "n_places")]
        now = now.groupBy(F.substring("node", 1, level).alias("parent")).agg(*totals, _joined(F.col("node"), F.col("digest")).alias("digest")).withColumnRenamed("parent", "node")
        out = out.unionByName(now.select(F.lit(level).alias("level"), *NODE[1:]))
    return out


def written_tree(rows: DataFrame, depth: int) -> DataFrame:
    """The tree of placed rows as a table of its own; rows are read once."""
    leaf = written(leaves(rows, depth), "leaves")
    out = written(tree(leaf, depth), "tree")
    deleted(leaf)
    return out


def unequal(expected: DataFrame, actual: DataFrame, depth: int) -> DataFrame:
    """level, node of the nodes that differ; below equal nodes nothing is compared."""

    def at(tree: DataFrame, level: int, parents: DataFrame | None) -> DataFrame:
        nodes = tree.where(F.col("level") == level).select("node", "digest")
        if parents is None:
            return nodes
        return nodes.withColumn("parent", F.substring("node", 1, level - 1)).join(parents, "parent", "left_semi").drop("parent")

    found, parents = None, None
    for level in range(depth + 1):
        e, a = at(expected, level, parents), at(actual, level, parents)
        both = e.withColumnRenamed("digest", "e").join(a.withColumnRenamed("digest", "a"), "node", "full_outer")
        wrong = both.where(~F.col("e").eqNullSafe(F.col("a"))).select(F.lit(level).alias("level"), "node")
        found = wrong if found is None else found.unionByName(wrong)
        parents = wrong.select(F.col("node").alias("parent"))
    return found


def descent(expected: DataFrame, actual: DataFrame, wrong: DataFrame) -> DataFrame:
    """level, n_nodes (of either tree) and n_unequal: how far two tables have to be read; wrong: of ``unequal``."""
    nodes = expected.select("level", "node").unionByName(actual.select("level", "node")).distinct().groupBy("level").agg(F.count("*").alias("n_nodes"))
    found = wrong.groupBy("level").agg(F.count("*").alias("n_unequal"))
    return nodes.join(found, "level", "left").select("level", "n_nodes", F.coalesce("n_unequal", F.lit(0).cast("bigint")).alias("n_unequal"))


def in_unequal_leaves(rows: DataFrame, wrong: DataFrame, depth: int) -> DataFrame:
    """Placed rows whose leaf is among the unequal nodes."""
    leaf = wrong.where(F.col("level") == depth).select(F.col("node").alias("leaf"))
    return rows.withColumn("leaf", F.substring("place", 1, depth)).join(leaf, "leaf", "left_semi").drop("leaf")


def compared(expected: DataFrame, actual: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    """identity and side (missing, extra or changed) of placed rows that differ. Rows meet by identity and bring their digest as bytes;
    texts and whole numbers tell places apart by themselves, of other types the place is a key too."""
    plain = all(expected.schema[c].dataType.typeName() in ("string", "byte", "short", "integer", "long", "boolean", "date") for c in identity)
    rows = lambda df, e: df.select(*(() if plain else ("place",)), *identity, F.unhex("row_sha256").alias("row"), F.lit(e).alias("e"))
    both = rows(expected, 1).unionByName(rows(actual, 0))
    side = lambda e: F.max(F.when(F.col("e") == e, F.col("row")))
    one = both.groupBy(*(() if plain else ("place",)), *identity).agg(side(1).alias("x"), side(0).alias("y"))
    kind = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").when(F.col("x") != F.col("y"), "changed")
    return one.select(*identity, kind.alias("side")).where("side IS NOT NULL")


def refuse_repeats(rows: DataFrame, nodes: DataFrame, identity: tuple[str, ...]) -> None:
    """A comparison by identity needs each once. The root tells; only then is the table searched for one to name."""
    if not nodes.where("level = 0 AND n_rows > n_places").isEmpty():
        found = repeated(rows, identity).orderBy(*identity).first()
        raise ValueError(f"DUPLICATE_IDENTITY: {' '.join(str(found[c]) for c in identity)} stands {found.n_rows} times")


def located(expected: DataFrame, actual: DataFrame, identity: tuple[str, ...], depth: int) -> DataFrame:
    """Identities in which two tables of equal columns differ, with the side; repeated identities are refused."""
    both = [placed(df.select(*expected.columns), identity) for df in (expected, actual)]
    trees = [written_tree(rows, depth) for rows in both]
    for rows, nodes in zip(both, trees, strict=True):
        refuse_repeats(rows, nodes, identity)
    wrong = written(unequal(*trees, depth), "unequal")
    deleted(*trees)
    return compared(*(in_unequal_leaves(rows, wrong, depth) for rows in both), identity)


def first_difference(differences: DataFrame, identity: tuple[str, ...]) -> list:
    """The first differing identity in the order of its columns, or none: each task keeps one row."""
    return differences.orderBy(*identity, "side").limit(1).collect()


def publish(df: DataFrame, place: str, identity: tuple[str, ...], depth: int) -> None:
    """Write df by place, in folders of the first digits, and its tree beside it; repeated identities are refused."""
    if not BLOCK_DIGITS <= depth <= MOST_DEPTH:
        raise ValueError(f"depth must be {BLOCK_DIGITS} to {MOST_DEPTH}")
    rows = placed(df, identity).withColumn("block", F.concat(F.lit("x"), F.substring("place", 1, BLOCK_DIGITS)))  # never read as a number
    nodes = written_tree(rows, depth)
    refuse_repeats(rows, nodes, identity)
    rows.repartitionByRange("place").sortWithinPartitions("place").write.mode("errorifexists").partitionBy("block").parquet(f"{place}/rows")
    nodes.write.mode("errorifexists").parquet(f"{place}/tree")
    deleted(nodes)


def opened(spark: SparkSession, place: str, blocks: list[str] | None = None) -> DataFrame:
    """The placed rows of a published table, of some blocks only; folders of others are not read."""
    rows = spark.read.parquet(f"{place}/rows")
    if blocks is not None:
        rows = rows.where(F.col("block").isin(*(f"x{b}" for b in blocks)) if blocks else F.lit(False))
    return rows.drop("block")


def located_between(spark: SparkSession, expected: str, actual: str, identity: tuple[str, ...], depth: int) -> tuple[DataFrame, DataFrame]:
    """``located`` for two published tables, and the descent. The trees name the blocks that are read, at most 256."""
    trees = [spark.read.parquet(f"{p}/tree") for p in (expected, actual)]
    wrong = written(unequal(*trees, depth), "unequal")
    named = [r.node for r in wrong.where(F.col("level") == BLOCK_DIGITS).select("node").collect()]
    rows = [in_unequal_leaves(opened(spark, p, named), wrong, depth) for p in (expected, actual)]
    return compared(*rows, identity), descent(*trees, wrong)
