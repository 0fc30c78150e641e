"""URL filter: host and path rules, and a blocklist held as Bloom filter cascades.

A cascade stores a set of listed keys exactly with respect to a finite key universe. Level 0 is a
Bloom filter of the listed keys; level 1 encodes the universe's keys that pass level 0 without
being listed; level 2 the listed keys that pass level 1; and so on until no false positive is
left. A key of the universe is listed iff the first level that rejects it has an odd number.
The universe is every key that any URL of the corpus can ask for, so answers are exact and no join
is needed: the levels are literals inside the filter expression.

Sizes: level 0 gets log2(universe / listed) + 1 bits a key or so, so about as many universe keys
pass it as are listed. What the driver collects is bounded by the list, not by the corpus.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no rule, and
gets ``allow``. Repeated rows each get their row. Extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contract's rules: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Hosts that are blocked, with their subdomains, where no rule fits (the default blocklist).
LISTED = tuple(
    f"{name}.example.{tld}"
    for name in ("casino-win", "free-bets", "cheap-pills", "ads-track", "spam-farm", "adult-x")
    for tld in ("com", "net", "org")
)
MOST_LEVELS = 24
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    return F.substr(text, F.length(F.substring_index(text, "://", 1)) + F.lit(4))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


class Cascade:
    """The finished filter: levels of (bit array as 64-bit words, bits, hash count)."""

    def __init__(self, levels: Sequence[tuple[list[int], int, int]]):
        self.levels = list(levels)

    @property
    def bits(self) -> int:
        return sum(m for _, m, _ in self.levels)

    def contains(self, key: Column) -> Column:
        """Exact for keys of the universe that the cascade was built over."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for depth in reversed(range(len(self.levels))):
            verdict = F.when(~_passes(self.levels[depth], key, depth), F.lit(depth % 2 == 1)).otherwise(verdict)
        return verdict if self.levels else F.lit(False)


def _hashes(key: Column, depth: int) -> tuple[Column, Column]:
    """Two hashes of 31 bits for double hashing."""
    h = F.xxhash64(key, F.lit(depth))
    return F.shiftrightunsigned(h, 33), h.bitwiseAND(F.lit(0x7FFFFFFF))


def _passes(level: tuple[list[int], int, int], key: Column, depth: int) -> Column:
    words, m, k = level
    # Folded into one constant when the plan is made, instead of an expression for each word.
    table = F.from_json(F.lit(json.dumps(words)), "array<bigint>")
    h1, h2 = _hashes(key, depth)
    tests = []
    for i in range(k):
        at = (h1 + F.lit(i) * h2) % F.lit(m)
        word = F.get(table, F.shiftright(at, 6).cast("int"))
        tests.append(F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _bloom(hashes: Iterable[tuple[int, int]], n: int, fpp: float) -> tuple[list[int], int, int]:
    m = max(64, math.ceil(-n * math.log(fpp) / math.log(2) ** 2))
    k = max(1, min(16, round(m / max(n, 1) * math.log(2))))
    words = [0] * (m // 64 + 1)
    for h1, h2 in hashes:
        for i in range(k):
            at = (h1 + i * h2) % m
            words[at >> 6] |= 1 << (at & 63)
    return [w - (1 << 64) if w >> 63 else w for w in words], m, k


def _values(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, keys))).alias("key"))


def build_cascade(listed: Sequence[str], universe: DataFrame, most_listed: int = 1_000_000) -> Cascade:
    """The cascade of ``listed`` over ``universe`` (one string column ``key``, repeats allowed).

    The universe is read once, reduced to its distinct keys, and only those that pass level 0 come
    to the driver: about as many as are listed, of which ``most_listed`` are accepted.
    """
    spark = universe.sparkSession
    listed = sorted(set(listed))
    if len(listed) > most_listed:
        raise ValueError(f"{len(listed)} listed keys; the bound is {most_listed}")
    if not listed:
        return Cascade([])
    every = [F.struct(*_hashes(F.col("key"), d)).alias(f"d{d}") for d in range(MOST_LEVELS)]
    at = {r.key: r for r in _values(spark, listed).select("key", *every).collect()}
    n_universe = universe.agg(F.approx_count_distinct("key").alias("n")).first().n
    share = len(listed) / max(n_universe, len(listed))
    pair = lambda r, d: (r[f"d{d}"][0], r[f"d{d}"][1])
    level0 = _bloom([pair(at[k], 0) for k in listed], len(listed), min(0.5, share * math.sqrt(0.5)))
    passing = universe.where(_passes(level0, F.col("key"), 0)).select("key").distinct().select("key", *every).collect()
    inside = [at[k] for k in listed]
    outside = [r for r in passing if r.key not in at]
    levels = [level0]
    while outside:
        depth = len(levels)
        if depth == MOST_LEVELS:
            raise RuntimeError("the cascade did not end")
        level = _bloom([pair(r, depth) for r in outside], len(outside), 0.5)
        levels.append(level)
        words, m, k = level

        def passes(r, d=depth, words=words, m=m, k=k) -> bool:
            h1, h2 = pair(r, d)
            return all((words[(x := (h1 + i * h2) % m) >> 6] >> (x & 63)) & 1 for i in range(k))

        inside, outside = outside, [r for r in inside if passes(r)]
    return Cascade(levels)


def _candidates(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every rule key that could fit: parent domain plus a path prefix of a length that rules use."""
    prefixes = F.array(*(F.when(F.length(path) >= n, F.substr(path, F.lit(1), F.lit(n))) for n in lengths))
    return F.flatten(F.transform(suffixes(host), lambda s: F.transform(F.array_compact(prefixes), lambda p: F.concat(s, p))))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    listed: Sequence[str] = LISTED,
) -> DataFrame:
    """page_id, host, path, rule, verdict, listed_host: the longest fitting rule decides, else the blocklist."""
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    lengths = sorted({len(p) for _, _, p in rules}, reverse=True)
    keys = {v: [h + p for verdict, h, p in rules if verdict == v] for v in ("allow", "block")}
    has_host = F.col("host") != ""
    places = base.where(has_host).select("host", "path")
    rule_universe = places.select(F.explode(_candidates(F.col("host"), F.col("path"), lengths)).alias("key"))
    host_universe = places.select(F.explode(suffixes(F.col("host"))).alias("key"))
    allow, block = (build_cascade(keys[v], rule_universe) for v in ("allow", "block"))
    blocklist = build_cascade(listed, host_universe)
    fitting = F.filter(
        F.col("candidates"), lambda c: allow.contains(c) | block.contains(c)
    )
    longest = F.reduce(fitting, F.lit(None).cast("string"), lambda best, c: F.when(best.isNull() | (F.length(c) > F.length(best)), c).otherwise(best))
    hit = F.filter(suffixes(F.col("host")), lambda s: blocklist.contains(s))
    return (
        base.withColumn("candidates", F.when(has_host, _candidates(F.col("host"), F.col("path"), lengths)).otherwise(F.array().cast("array<string>")))
        .select("page_id", "host", "path", longest.alias("rule"), F.when(has_host, F.get(hit, F.lit(0))).alias("listed_host"))
        .select(
            "page_id", "host", "path", "rule",
            F.when(F.col("rule").isNotNull(), F.when(allow.contains(F.col("rule")), "allow").otherwise("block"))
            .when(F.col("listed_host").isNotNull(), "block").otherwise("allow").alias("verdict"),
            "listed_host",
        )
    )
