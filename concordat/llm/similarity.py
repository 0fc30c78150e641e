"""N-gram Jaccard self-join with token-combination prefixes, and the components of its links.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents with equal sets
form a class with one representative; only representatives are compared.

Classes of tokens. Tokens fall into slots (their leading bits), and every slot is counted over all
documents. A slot's count makes its tokens lone (one), rare, frequent or very frequent; what counts
as frequent rises with the mean count of slots, so classes stay apart when slots fill up. A token's
class is the same for every document and only decides which keys are used, never whether a pair is
found.

Index keys. A similar set lacks at most d = n - ceil(t n) of a set's n tokens. Tokens are taken in
the order of their classes, then by hash. Lone and rare tokens are indexed singly; frequent tokens
are dealt by hash into groups and indexed by pairs within a group, very frequent ones by triples. A
group of g tokens of which k are combined still holds a shared combination after any g - k
losses, so it covers max(0, g - k + 1) of them. The prefix is extended until its tokens cover d + 1:
then, whatever d of them the other set lacks, some class or group keeps k shared tokens. Of two
similar sets the one whose prefix ends first has these in its prefix, and the other one's prefix
reaches beyond them, so both have the same combination as a key. Rare singles stand for themselves
(k = 1), and a lone token, which covers one loss too, needs no key because no other set has it.

The number of groups depends on the size bucket (powers of two), so that keys grow linearly with
the set. A set whose similar sets can be in the next bucket is indexed for that one as well. Where a
bucket's sets are too small for an extended prefix, k is lowered for the bucket.

Verification is exact on whole sets, of which only those are read again that are in a pair which
sizes and parity sketches don't rule out: a sketch of fixed width first, then one as wide as the set.
Each member of a key is first compared with the key's smallest member, its pivot (links to it join
most of a group of near copies). Then members of one pivot that are still in different components
are compared, once for all keys that they share: near copies share hundreds. Where a pivot's keys
have little in common, so that its members are more pairs than the keys' are, they meet by key.
Links found then join whole components, not documents.

Defined results: lower-casing is A-Z only; words are runs between ASCII blanks; fewer than k words
make one shingle of the whole sequence; null or wordless texts have an empty set and no links, also
where they share a doc_id. Other rows that share a doc_id are one node; a row without doc_id has a
null component. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concordat.llm.common import Steps
from concordat.llm.components import components

#: Tokens are counted by slots of their leading bits; two bits of class a slot make 16 MB, in so many ranges.
SLOT_BITS = 26
RANGES = 1024
#: Classes of tokens, and how many tokens of a class are combined in a key.
LONE, RARE, FREQUENT, COMMON = 0, 1, 2, 3
#: Rare tokens are met in so many documents at most (beside what a slot holds on average); common ones in COMMON_TIMES more.
RARE_MOST, COMMON_TIMES = 8, 8
#: Tokens that a task holds before it writes them or their counts.
HELD = 1 << 20
_SINGLE = np.uint64(0x6A09E667F3BCC909)
#: Bits of the narrow sketch; the wide one has as many at least, and a power of two that is WIDE_TIMES the set's size or more.
SKETCH_BITS, WIDE_TIMES = 512, 4
#: Pairs of a pivot's members above which its keys are counted to see which way has fewer.
PIVOT_PAIRS = 1 << 14
#: Members outside the pivot's component that one task compares with a whole group, about.
CHUNK = 256
#: Bits of the filter that spares documents without candidates the second reading.
FILTER_BITS = 1 << 25
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTES[_BLANK] = 0


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes.

    A word's hash is sum(code[byte_i] * B^i) modulo 2^64 for an odd B, taken for all words of a text
    at once from running sums.
    """

    def __init__(self, k: int):
        self.k = k
        self.powers = self.unpowers = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            with np.errstate(over="ignore"):
                for name, base in (("powers", _BASE), ("unpowers", _UNBASE)):
                    row = np.full(2 * n, base, np.uint64)
                    row[0] = 1
                    setattr(self, name, np.multiply.accumulate(row))

    def words(self, text: str | None) -> np.ndarray:
        """Hashes of the words in order."""
        data = np.frombuffer((text or "").encode().lower(), np.uint8)
        n = len(data)
        self._grow(n + 1)
        word = np.zeros(n + 2, np.int8)
        word[1:-1] = ~_BLANK[data]
        edge = np.diff(word)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTES[data] * self.powers[:n], out=sums[1:])
            return _mix((sums[end] - sums[start]) * self.unpowers[start])

    def __call__(self, text: str | None) -> np.ndarray:
        codes = self.words(text)
        if not len(codes):
            return codes
        k = min(self.k, len(codes))
        n = len(codes) - k + 1
        with np.errstate(over="ignore"):
            total = np.full(n, k, np.uint64)
            for i in range(k):
                total += codes[i : n + i] * MULTIPLIERS[i % 5]
                total ^= total >> np.uint64(29)
        total = np.sort(_mix(total))
        return total[np.concatenate(([True], total[1:] != total[:-1]))]


def prefix_length(n: int, num: int, den: int) -> int:
    """n - ceil(num n / den) + 1."""
    return n - -(-num * n // den) + 1


@dataclass(frozen=True)
class Scheme:
    """How the frequent tokens of a size bucket are combined: groups and tokens a combination, for FREQUENT and COMMON."""

    bucket: int
    groups: tuple[int, int]
    sizes: tuple[int, int]


@lru_cache(maxsize=256)
def scheme_of(bucket: int, num: int, den: int) -> Scheme:
    """The scheme of sets of 2^bucket tokens to twice as many; its combinations are as large as the smallest prefix allows."""
    high = (2 << bucket) - 1
    lost = prefix_length(high, num, den) - 1
    groups = max(1, lost // 4), max(1, lost // 3)
    sizes = np.unique(np.linspace(-(-num * (1 << bucket) // den), high, 4096).astype(np.int64))
    spare = int((sizes - prefix_length(sizes, num, den)).min())
    for combined in ((2, 3), (2, 2), (1, 2), (1, 1)):
        # Each group may hold k - 1 tokens that cover nothing.
        if sum(g * (k - 1) for g, k in zip(groups, combined, strict=True)) <= spare:
            break
    return Scheme(bucket, groups, combined)


def _combinations(tokens: np.ndarray, group: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hashes of all combinations of so many tokens within a group; tokens are ordered, groups are not."""
    order = np.argsort(group, kind="stable")
    tokens, group = tokens[order], group[order]
    found, start = [], _mix(tokens + np.uint64(salt))
    if size == 1:
        return start
    reach = int(np.bincount(group).max(initial=0))
    for i in range(1, reach):
        same = group[i:] == group[:-i]
        pair = _mix(start[:-i] * MULTIPLIERS[0] + tokens[i:])
        if size == 2:
            found.append(pair[same])
            continue
        for j in range(i + 1, reach):
            whole = group[j:] == group[:-j]
            found.append(_mix(pair[: len(tokens) - j] * MULTIPLIERS[1] + tokens[j:])[whole])
    return np.concatenate(found) if found else tokens[:0]


def index_keys(tokens: np.ndarray, kind: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of which every similar, different set has one too; kind: the class of each token, which are sorted."""
    n = len(tokens)
    needed = prefix_length(n, num, den)
    if needed == 1 and n * den // num == n:  # only equal sets are similar
        return tokens[:0]
    lone = int((kind == LONE).sum())
    if lone >= needed:
        return tokens[:0]
    rare = tokens[kind == RARE][: needed - lone]
    with np.errstate(over="ignore"):
        keys = [_mix(rare ^ _SINGLE)]
        needed -= lone + len(rare)
        buckets = range(n.bit_length() - 1, (n * den // num).bit_length()) if needed else ()
        for scheme in (scheme_of(b, num, den) for b in buckets):
            left = needed
            for of_class, groups, size in zip((FREQUENT, COMMON), scheme.groups, scheme.sizes, strict=True):
                own = tokens[kind == of_class]
                if not left or not len(own):
                    continue
                group = (_mix(own + np.uint64(of_class)) % np.uint64(groups)).astype(np.int64)
                covering = _rank(group) >= size - 1
                covered = np.cumsum(covering)
                end = int(np.searchsorted(covered, left)) + 1
                keys.append(_combinations(own[:end], group[:end], size, (scheme.bucket << 8) + of_class << 32))
                left -= min(left, int(covered[min(end, len(own)) - 1]))
            if left:
                raise AssertionError(f"a set of {n} tokens has no whole prefix")
    return np.unique(np.concatenate(keys))


def _rank(group: np.ndarray) -> np.ndarray:
    """How many earlier elements are in the same group."""
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    at = np.arange(len(group))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], ordered[1:] != ordered[:-1])), at, 0))
    rank = np.empty(len(group), np.int64)
    rank[order] = at - first
    return rank


def parity_sketch(tokens: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parities of the token counts of so many buckets (a power of two), as 64-bit words. Sets that differ
    in d tokens differ in at most d bits, so a larger difference rules a pair out exactly. A sketch of
    half the width is the exclusive or of both halves."""
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(tokens: np.ndarray) -> np.ndarray:
    """A sketch that grows with the set, so that it isn't full of odd counts."""
    return parity_sketch(tokens, max(SKETCH_BITS, 1 << (WIDE_TIMES * len(tokens) - 1).bit_length()))


def narrowed(wide: np.ndarray) -> np.ndarray:
    """The sketch of SKETCH_BITS from a wide one."""
    return np.bitwise_xor.reduce(wide.reshape(-1, SKETCH_BITS // 64), axis=0)


def _ids(column: pd.Series) -> list:
    return column.astype(object).where(column.notna(), None).tolist()


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _pack_counts(at: np.ndarray, counts: np.ndarray) -> bytes:
    """Places within a range (16 bits, ascending) and counts up to 255, compressed: about a byte a place."""
    gaps = np.diff(at.astype(np.int32), prepend=0).astype(np.uint16)
    planes = ((gaps & 255).astype(np.uint8), (gaps >> 8).astype(np.uint8), np.minimum(counts, 255).astype(np.uint8))
    return zlib.compress(b"".join(p.tobytes() for p in planes), 1)


def _add_counts(total: np.ndarray, data: bytes) -> None:
    low, high, counts = np.frombuffer(zlib.decompress(data), np.uint8).reshape(3, -1)
    total[np.cumsum(low + high.astype(np.int64) * 256)] += counts


def classes_of(counts: np.ndarray) -> np.ndarray:
    """LONE, RARE, FREQUENT or COMMON by count; the mean count and its noise don't make a slot frequent."""
    mean = float(counts.mean())
    rare = RARE_MOST + int(mean + 4 * math.sqrt(mean))
    return (counts > 1).astype(np.uint8) + (counts > rare) + (counts > rare * COMMON_TIMES)


def slot_classes(documents: DataFrame, k: int) -> np.ndarray:
    """The class of every slot, two bits each: 2^(SLOT_BITS - 2) bytes, whatever the corpus.

    Every task counts the slots of its documents and writes about a byte for each that it met; each
    range of slots is then summed in constant memory.
    """
    width = (1 << SLOT_BITS) // RANGES

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, held, size = Shingler(k), [], 0

        def flush() -> pd.DataFrame:
            slots, counts = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(slots, np.arange(RANGES + 1) * width)
            spans = [(r, a, b) for r, (a, b) in enumerate(itertools.pairwise(ends.tolist())) if a < b]
            return pd.DataFrame({"part": [r for r, _, _ in spans], "counts": [_pack_counts(slots[a:b] - r * width, counts[a:b]) for r, a, b in spans]})

        for batch in batches:
            sets: set[bytes] = set()
            for text in batch["text"]:
                tokens = shingle(text)
                raw = xxhash.xxh3_128_digest(tokens.tobytes())
                if raw in sets or not len(tokens):  # copies within a batch say nothing about their tokens
                    continue
                sets.add(raw)
                held.append(_slots(tokens).astype(np.int32))
                size += len(tokens)
                if size >= HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, counts = None, np.zeros(width, np.int64)

        def done() -> pd.DataFrame:
            kinds = classes_of(counts).reshape(-1, 4)
            return pd.DataFrame({"part": [now], "kinds": [(kinds[:, 0] | kinds[:, 1] << 2 | kinds[:, 2] << 4 | kinds[:, 3] << 6).tobytes()]})

        for batch in batches:
            for part, data in zip(batch["part"], batch["counts"], strict=True):
                if part != now:
                    if now is not None:
                        yield done()
                    now, counts = part, np.zeros(width, np.int64)
                _add_counts(counts, data)
        if now is not None:
            yield done()

    counted = documents.select("text").mapInPandas(count, "part int, counts binary")
    rows = counted.repartition("part").sortWithinPartitions("part").mapInPandas(total, "part int, kinds binary").collect()
    kinds = np.zeros((RANGES, width // 4), np.uint8)
    for r in rows:
        kinds[r.part] = np.frombuffer(r.kinds, np.uint8)
    return kinds.reshape(-1)


def _kinds(tokens: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    at = _slots(tokens)
    return kinds[at >> 2] >> (2 * (at & 3)).astype(np.uint8) & 3


def _index(documents: DataFrame, k: int, num: int, den: int, kinds: Broadcast) -> DataFrame:
    """doc_id, n (set size), h1, h2 (hashes of the set), keys, narrow and wide parity sketch (of documents with keys)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, of_slot = Shingler(k), kinds.value
        for batch in batches:
            rows = []
            for doc, text in zip(_ids(batch["doc_id"]), batch["text"], strict=True):
                tokens = shingle(text)
                keys = index_keys(tokens, _kinds(tokens, of_slot), num, den).view(np.int64) if len(tokens) else np.empty(0, np.int64)
                raw = tokens.tobytes()
                wide = wide_sketch(tokens) if len(keys) else None
                rows.append((doc, len(tokens), xxhash.xxh3_64_intdigest(raw) - (1 << 63), xxhash.xxh64_intdigest(raw) - (1 << 63), keys, None if wide is None else narrowed(wide), wide))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "h1", "h2", "keys", "sketch", "wide"]).astype({"doc_id": "Int64"})

    return documents.select("doc_id", "text").mapInPandas(run, "doc_id long, n long, h1 long, h2 long, keys array<long>, sketch array<long>, wide array<long>")


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """A bit filter of ids as FILTER_BITS / 64 words of 64 bits: 4 MB, whatever the ids."""
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    rows = ids.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    found = rows.toArrow()
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words


def _sets(documents: DataFrame, pairs: DataFrame, k: int, steps: Steps) -> DataFrame:
    """id, n, tokens of the documents of pairs (and of few others, which a bit filter of ids lets through)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = documents.sparkSession.sparkContext.broadcast(_filter_bits(ids))
    names = ["id", "n", "tokens"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, bits = Shingler(k), wanted.value
        for batch in batches:
            at = batch["at"].to_numpy()
            keep = batch[(bits[at >> 6] >> (at & 63)) & 1 == 1]
            rows, size = [], 0
            for doc, text in zip(keep["doc_id"], keep["text"], strict=True):
                tokens = shingle(text)
                rows.append((doc, len(tokens), tokens.view(np.int64)))
                size += len(tokens)
                if size >= HELD:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)

    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("at"))
    sets = steps.save(rows.mapInPandas(run, "id long, n long, tokens array<long>"), "sets")
    wanted.destroy()
    return sets


def _possible(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that sizes (na, nb) and narrow parity sketches (sa, sb) don't rule out."""
    fits = (F.col("na") * num <= F.col("nb") * den) & (F.col("nb") * num <= F.col("na") * den)
    bits = sum((F.bit_count(F.get("sa", F.lit(i)).bitwiseXOR(F.get("sb", F.lit(i)))) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return pairs.where(fits & (bits * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)))


def _sharpened(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b, other columns) that wide parity sketches, brought to the width of the narrower one, don't rule out."""
    side = lambda end: nodes.select(F.col("doc_id").alias(end), F.col("n").alias("n" + end), F.col("wide").alias("w" + end))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("width", F.least(F.size("wa"), F.size("wb")))

    def folded(wide: str) -> Column:
        parts = F.sequence(F.lit(0), (F.size(wide) / F.col("width")).cast("int") - 1)
        half = lambda i: F.slice(F.col(wide), i * F.col("width") + 1, F.col("width"))
        return F.aggregate(parts, F.array_repeat(F.lit(0).cast("long"), F.col("width")), lambda all_, i: F.zip_with(all_, half(i), lambda x, y: x.bitwiseXOR(y)))

    apart = F.zip_with(folded("wa"), folded("wb"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    bits = F.aggregate(apart, F.lit(0), lambda total, x: total + x)
    return both.where(bits * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)).select(*pairs.columns).distinct()


def _verify(documents: DataFrame, pairs: DataFrame, k: int, num: int, den: int, steps: Steps, name: str) -> DataFrame:
    """Links among saved pairs (a, b, other columns): num (|A| + |B|) <= (num + den) |A & B|, row by row in the JVM."""
    sets = _sets(documents, pairs, k, steps)
    side = lambda end: sets.select(F.col("id").alias(end), F.col("n").alias("n" + end), F.col("tokens").alias("t" + end))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    links = steps.save(both.where((F.col("na") + F.col("nb")) * num <= shared * (num + den)).select(*pairs.columns), name)
    steps.drop(sets, pairs)
    return links


def linked(documents: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the components of links at num/den or more."""
    context, steps = documents.sparkSession.sparkContext, Steps(documents.sparkSession)
    kinds = context.broadcast(slot_classes(documents, k))
    index = steps.save(_index(documents, k, num, den, kinds), "index")
    kinds.destroy()
    same = index.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    multiple = steps.save(same.where("copies > 1").drop("copies"), "multiple")
    # Members of a class point at its representative. The join is one of its own, so that Spark can split a hot class.
    own = F.when(F.col("rep").isNull() | (F.col("rep") == F.col("doc_id")), F.col("keys"))
    classes = steps.save(index.join(multiple, ["n", "h1", "h2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), own.alias("keys"), "sketch", "wide"), "classes")
    steps.drop(index, multiple)
    inverted = classes.where("size(keys) > 0 AND doc_id IS NOT NULL").select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"))
    pivots = steps.save(inverted.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("other")).where("pivot < other").drop("other"), "pivots")
    groups = steps.save(inverted.join(pivots, "key"), "groups")
    steps.drop(pivots)
    nodes = classes.where("size(keys) > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "sketch", "wide")
    end = lambda e: nodes.select(F.col("doc_id").alias(e), F.col("n").alias("n" + e), F.col("sketch").alias("s" + e))
    spokes = steps.save(groups.where("id <> pivot").select("pivot", "id").distinct(), "spokes")
    first = spokes.select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    possible = steps.save(_possible(first.join(end("a"), "a").join(end("b"), "b"), num, den).select("a", "b").distinct(), "possible")
    pairs = steps.save(_sharpened(possible, nodes, num, den), "pairs")
    steps.drop(possible)
    links = _verify(documents, pairs, k, num, den, steps, "links")
    known = components(links, steps)
    steps.drop(links)
    rest = _unsettled(groups, spokes, known, nodes, num, den, steps)
    steps.drop(groups, spokes)
    joins = _shared_ids(classes, known)
    if not rest.isEmpty():
        joins = joins.unionByName(_verify(documents, rest, k, num, den, steps, "more").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joins = steps.save(joins.distinct(), "joins")
    labels = known
    if not joins.isEmpty():
        labels = steps.save(_relabel(known, over := components(joins, steps)), "labels")
        steps.drop(known, over)
    steps.drop(joins)
    # A representative is its class's smallest document, so copies take its component as theirs.
    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"))


def _shared_ids(classes: DataFrame, known: DataFrame) -> DataFrame:
    """Edges between the components of classes that rows of one doc_id are in."""
    several = classes.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("doc_id")
    edges = classes.where("n > 0").join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    for end in ("a", "b"):
        edges = edges.join(known.select(F.col("node").alias(end), F.col("component").alias("c" + end)), end, "left").withColumn(end, F.coalesce("c" + end, end))
    return edges.select("a", "b").where("a <> b")


def _relabel(known: DataFrame, over: DataFrame) -> DataFrame:
    """(node, component) when the components of known are nodes of over; nodes of over that known doesn't name are kept."""
    up = over.select(F.col("node").alias("component"), F.col("component").alias("upper"))
    moved = known.join(up, "component", "left").select("node", F.coalesce("upper", "component").alias("component"))
    return moved.unionByName(over.join(known.select("node"), "node", "left_anti"))


def _unsettled(groups: DataFrame, spokes: DataFrame, known: DataFrame, nodes: DataFrame, num: int, den: int, steps: Steps) -> DataFrame:
    """Pairs with a common key that are in different components and were not compared with the pivot.

    Members of a pivot (spokes) outside its component meet all its members in other components; in a
    group of near copies these are the few that the pivot doesn't reach. Documents with a common key
    have that key's pivot in common, so no pair is left out, and it is met once a pivot, not once a key.
    """
    members = _members(groups, spokes, known, nodes, steps)
    met = _possible(_meetings(members), num, den)
    met = steps.save(met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.greatest("ca", "cb").alias("ca"), F.least("ca", "cb").alias("cb")).distinct(), "met")
    pairs = steps.save(_sharpened(met, nodes, num, den), "rest")
    steps.drop(members, met)
    return pairs


def _members(groups: DataFrame, spokes: DataFrame, known: DataFrame, nodes: DataFrame, steps: Steps) -> DataFrame:
    """pivot, key, id, component, outside (the pivot's component), n, sketch, of groups that hold several components.

    key is 0 where all members of a pivot are one group, which a pivot with few pairs, or with fewer than
    its keys have, always is.
    """
    up = known.select(F.col("node").alias("id"), "component")
    centres = known.select(F.col("node").alias("pivot"), F.col("component").alias("centre"))
    outside = F.coalesce("component", "id") != F.coalesce("centre", "pivot")
    named = spokes.join(up, "id", "left").join(centres, "pivot", "left").select("pivot", "id", F.coalesce("component", "id").alias("component"), outside.alias("outside"))
    named = steps.save(named, "named")
    several, product = F.count_if("outside"), (F.count_if("outside") * F.count("*").cast("double"))
    counts = steps.save(named.groupBy("pivot").agg(several.alias("several"), product.alias("pairs")).where("several > 0"), "counts")
    large = counts.where(F.col("pairs") > PIVOT_PAIRS).select("pivot", "pairs")
    keyed = groups.where("id <> pivot").join(large.select("pivot"), "pivot").join(named, ["pivot", "id"])
    by_key = keyed.groupBy("pivot", "key").agg(product.alias("here")).groupBy("pivot").agg(F.sum("here").alias("by_key"))
    apart = steps.save(by_key.join(large, "pivot").where("by_key < pairs").select("pivot"), "apart")
    columns = ["pivot", "key", "id", "component", "outside"]
    whole = named.join(counts.select("pivot"), "pivot").join(apart, "pivot", "left_anti").withColumn("key", F.lit(0).cast("long")).select(*columns)
    single = groups.where("id <> pivot").join(apart, "pivot").join(named, ["pivot", "id"]).select(*columns)
    members = steps.save(whole.unionByName(single).join(nodes.select(F.col("doc_id").alias("id"), "n", "sketch"), "id"), "members")
    steps.drop(named, counts, apart)
    return members


def _meetings(members: DataFrame) -> DataFrame:
    """Pairs of different components in a group, one of them outside the pivot's component, with sizes and sketches.

    Members outside are dealt to chunks that each meet the whole group, so a large group is several tasks' work.
    """
    chunks = members.groupBy("pivot", "key").agg(F.ceil(F.count_if("outside") / CHUNK).cast("int").alias("chunks")).where("chunks > 0")
    rows = members.join(chunks, ["pivot", "key"])
    group = ["pivot", "key", "chunk"]
    left = rows.where("outside").select("*", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"))
    right = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    side = lambda df, x, *more: df.select(*group, F.col("id").alias(x), F.col("n").alias("n" + x), F.col("component").alias("c" + x), F.col("sketch").alias("s" + x), *more)
    # Two members outside meet once; the one inside can have either id.
    return side(left, "a").join(side(right, "b", "outside"), group).where((F.col("ca") != F.col("cb")) & (~F.col("outside") | (F.col("a") > F.col("b"))))


def first_of_each(documents: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """documents without near duplicates: of each component the row with the smallest doc_id stays.

    Rows with an empty set or without doc_id stay. Of rows that share the smallest doc_id one stays
    if their texts are equal; rows with one doc_id and different texts are one node, of which the
    smallest text stays. Columns are those of documents. Texts meet only the ids of rows that go,
    which Spark broadcasts while that table is small.
    """
    names, steps = documents.columns, Steps(documents.sparkSession)
    verdicts = steps.save(linked(documents, k, num, den).where("n_shingles > 0 AND doc_id IS NOT NULL"), "verdicts")
    gone = steps.save(verdicts.where("component_id < doc_id").select(F.col("doc_id").alias("__id")).distinct(), "gone")
    repeated = steps.save(verdicts.where("component_id = doc_id").groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("rows")).where("rows > 1").select("__id"), "repeated")
    steps.drop(verdicts)
    # Rows without words have no key here, so nothing removes them.
    keyed = documents.withColumn("__id", F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("doc_id")))
    kept = keyed.join(gone, "__id", "left_anti")
    if repeated.isEmpty():
        return kept.select(*names)
    order = [F.col(f"`{c}`").cast("string") for c in ["text", *[c for c in names if c != "text"]]]
    one = kept.join(repeated, "__id", "left_semi").withColumn("__at", F.row_number().over(Window.partitionBy("__id").orderBy(*order))).where("__at = 1")
    return kept.join(repeated, "__id", "left_anti").select(*names).unionByName(one.select(*names))


def jaccard(a: Iterable[int], b: Iterable[int]) -> float:
    """For tests."""
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else math.nan


def sets_of(spark: SparkSession, texts: dict[int, str], k: int) -> dict[int, np.ndarray]:
    """For tests: sets by id, computed on the driver."""
    shingle = Shingler(k)
    return {i: shingle(t) for i, t in texts.items()}
