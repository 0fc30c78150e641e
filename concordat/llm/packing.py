"""Best-fit decreasing packing of tokenised documents into sequences of bounded length.

Pieces of one length are interchangeable, and so are open bins of one remaining capacity. Best-fit
decreasing over all documents therefore needs only how many pieces there are of each length: at
most ``capacity`` numbers, whatever the corpus. A segment tree over the capacities finds the
tightest open bin in logarithmic time; runs of equal pieces are placed in bulk. The plan says
which ranks within a length go to which bins, and every piece takes its rank by a counted,
bucketed numbering, so no task sees more than one bucket of one length and nothing grows on the
driver.

Documents longer than the capacity are cut into full pieces; the first piece takes what is left
over and is packed with the rest; full pieces fill a sequence each.

Defined results: null text is empty (one id: the end mark). Empty tables give no rows. Repeated
rows are packed each on its own; rows with one doc_id keep separate pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.llm.bpe import fast_tokenizer
from concordat.llm.common import materialize

CAPACITY = 2048
END = b"\0\0\0\0"
#: Pieces numbered together; buckets grow with the corpus so that one stays about this large.
BUCKET_ROWS = 5_000
PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and the remainder in front."""
    first = n % capacity if n > capacity else n
    starts = [(0, first)] if first else []
    return starts + [(s, capacity) for s in range(first, n, capacity)]


def tokenised_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of every piece."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = fast_tokenizer(path)
        for batch in batches:
            rows = []
            ids = batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None)
            for doc, code in zip(ids, bpe.encode_all("" if t is None else t for t in batch["text"]), strict=True):
                code += END
                for i, (start, n) in enumerate(cut_points(len(code) // 4, capacity)):
                    own = code[4 * start : 4 * (start + n)]
                    rows.append((doc, i, start, n, zlib.crc32(own), *([own] if keep_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return documents.select("doc_id", "text").mapInPandas(run, PIECES_SCHEMA + ", ids binary" * keep_ids)


class CapacityTree:
    """Segment tree over remaining capacities 0..n: how many open bins have each, and the tightest that fits."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += bins
            i //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least that an open bin has."""
        i = least + self.leaves
        if self.count[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                break
            i //= 2
        else:
            return None
        while i < self.leaves:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.leaves


@dataclass
class Placement:
    """Pieces of ``length`` with ranks first..first+n-1 go, ``each`` to a bin, into bins from ``bin`` on."""

    length: int
    first: int
    n: int
    bin: int
    each: int
    offset: int


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Placement], int]:
    """Best-fit decreasing over counts (length -> pieces); returns the plan and the number of bins."""
    tree, ranges, plan, bins = CapacityTree(capacity), {}, [], 0

    def put(room: int, start: int, n: int) -> None:
        if n and room:
            ranges.setdefault(room, []).append((start, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} in sequences of {capacity}")
        while left:
            room = tree.tightest(length)
            if room is None:
                room, start, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                start, n = ranges[room].pop()
                tree.add(room, -n)
            each = room // length  # a bin just used is the tightest until nothing more fits
            used = min(n, -(-left // each))
            if used < n:
                put(room, start + used, n - used)
            placed = min(left, used * each)
            plan.append(Placement(length, rank, placed, start, each, capacity - room))
            whole, rest = divmod(placed, each)
            put(room - each * length, start, whole)
            if rest:
                put(room - rest * length, start + whole, 1)
            rank, left = rank + placed, left - placed
    return plan, bins


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns ``doc_id piece start length``, others kept).

    ``pieces`` should be a written table: it is read for counts, for numbering and for the result.
    """
    spark = pieces.sparkSession
    total = pieces.count()
    buckets = max(1, total // BUCKET_ROWS + 1)
    keys = [c for c in pieces.columns if c not in ("ids",)]
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    counted = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # Running counts: one row for each length and bucket; the window sees counts, not pieces.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    based = counted.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    lengths = {r.length: r.n for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = plan_best_fit(lengths, capacity)
    ranked = bucketed.withColumn("rank_in", F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*keys))).join(based, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("rank_in") - 1)
    by_length: dict[int, list] = {}
    for p in plan:
        by_length.setdefault(p.length, []).append((p.first, p.n, p.bin, p.each, p.offset))
    steps = spark.createDataFrame(sorted(by_length.items()), "length long, steps array<struct<first:long,n:long,bin:long,each:long,offset:long>>")
    step = F.get(F.filter("steps", lambda s: (F.col("rank") >= s["first"]) & (F.col("rank") < s["first"] + s["n"])), F.lit(0))
    # The plan has at most one row for each length up to the capacity.
    placed = ranked.join(F.broadcast(steps), "length").withColumn("step", step)
    within = F.col("rank") - F.col("step.first")
    return placed.select(
        *pieces.columns,
        (F.col("step.bin") + F.floor(within / F.col("step.each"))).cast("long").alias("sequence_id"),
        (F.col("step.offset") + F.pmod(within, F.col("step.each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack whole documents."""
    return pack(materialize(tokenised_pieces(documents, path, capacity, keep_ids), "pieces"), capacity)
