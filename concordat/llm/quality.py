"""Quality rules with risk-controlled thresholds, all in DataFrame expressions.

Rule statistics come from words ``[^\\x20\\x09-\\x0D]+`` and lines of whole texts, computed inside the
row: no text is shuffled. Fixed base rules reject first. Then, for each stratum (by default the
language), cutoffs of all scored rules are selected together on labelled rows: they are tightened
step by step in an order fixed beforehand, as long as the exact binomial (Clopper-Pearson) upper
bound for the rate of good documents that any of them rejects is at most ``alpha``. The order
comes from the bad and the unlabelled documents only (``tightening``), never from the good ones
that the bound is computed on, and the first step that fails ends it, so steps and rules need no
correction (fixed sequence testing). The error ``delta`` is divided by the strata that have enough
good labels for any cutoff (Bonferroni), so all selected cutoffs hold at once with probability
1 - delta: no stratum loses more than ``alpha`` of its good documents to the method. A stratum
with fewer, where even no good document rejected would not do, keeps all that the base rules keep.

Defined results: null or wordless text has no words and fails the base rule; a null stratum is a
stratum of its own ('' after coalescing); label rows that are null, repeated or without a document
don't count twice or at all (a document is good if any of its label rows says so). Extra columns
are ignored. Repeated rows each get their row.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import materialize

#: Word separators as in the contract.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
ALPHA = 0.01
DELTA = 0.05
#: Scored rules (all: larger is worse) with the grid of cutoffs; a document above its cutoff is rejected.
GRIDS: dict[str, tuple[float, ...]] = {
    "symbol_share": tuple(x / 200 for x in range(1, 101)),
    "dup_line_share": tuple(x / 50 for x in range(1, 50)),
    "repeat_share": tuple(x / 100 for x in range(1, 100)),
    "upper_share": tuple(x / 50 for x in range(2, 50)),
    "mark_share": tuple(x / 50 for x in range(1, 100)),
}


def words_of(text: Column) -> Column:
    """Array of words; empty for null and blank texts."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(_without(x, BLANKS)) > 0)
    return bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def bind(value: Column, use) -> Column:
    """use(value) with value computed once a row: expressions inside lambdas are otherwise
    evaluated for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of so many words that stand twice or more in the text.

    Windows are compared by 64-bit hashes first; only texts in which two hashes are equal go on to
    compare the windows themselves, so the count is exact either way.
    """
    gram = lambda w, i: F.slice(w, i, F.lit(window))

    def exact(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(w) - window + 1)
        tagged = F.sort_array(F.transform(at, lambda i: F.struct(F.array_join(gram(w, i), " ").alias("g"), i.alias("i"))))

        def covered(t: Column) -> Column:
            n = F.size(t)
            twice = F.filter(
                F.transform(t, lambda x, k: F.when((x["g"] == F.get(t, k + 1)["g"]) | (x["g"] == F.get(t, k - 1)["g"]), x["i"])),
                lambda i: i.isNotNull(),
            )
            state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).cast("int").alias("end"))
            step = lambda s, i: F.struct((s["n"] + F.least(F.lit(window), i + window - F.greatest(s["end"], F.lit(0)))).cast("long").alias("n"), (i + window).cast("int").alias("end"))
            return F.when(n < 2, F.lit(0).cast("long")).otherwise(F.reduce(F.sort_array(twice), state, step)["n"])

        return bind(tagged, covered)

    def count(w: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(w) - window + 1)
        hashes = F.transform(at, lambda i: F.xxhash64(gram(w, i)))
        return bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(exact(w)))

    return bind(words, lambda w: F.when(F.size(w) <= window, F.lit(0).cast("long")).otherwise(count(w)))


def measure(documents: DataFrame, stratum: str | None = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in carry, stratum and every statistic of the rules."""
    group = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    text = F.coalesce(F.col("text"), F.lit(""))
    base = documents.select("doc_id", *carry, group.alias("stratum"), text.alias("text"))
    letters = F.length(F.translate("text", "0123456789" + BLANKS + SYMBOLS + ".,;:!?\"'()[]{}-_=+/\\@^~`", ""))
    uppers = F.length("text") - F.length(_without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÎÏÍÌÔÖÓÒÙÛÜÚÑ"))
    marks = F.length("text") - F.length(_without(F.col("text"), "!?^~=+"))
    out = base.select(
        "doc_id", *carry, "stratum",
        bind(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("w"),
        F.length(_without(F.col("text"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        dup_lines(F.col("text")).alias("n_dup_lines"),
        F.size(F.split("text", "\n")).alias("n_lines"), letters.alias("letters"), uppers.alias("uppers"), marks.alias("marks"),
    ).select(
        "doc_id", *carry, "stratum", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.r").alias("n_repeat_words"), "n_lines", "letters", "uppers", "marks",
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)).cast("double")
    return out.select(
        "doc_id", *carry, "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("uppers", "letters").alias("upper_share"),
        share("marks", "n_words").alias("mark_share"),
    )


def bound_holds(n: int, rejected: int, rate: float, error: float) -> bool:
    """Whether the exact upper confidence bound (1 - error) of rejected/n is at most rate:
    P(Binomial(n, rate) <= rejected) <= error, summed in logarithms."""
    if n == 0 or rejected >= n * rate:
        return False
    log_term = n * math.log1p(-rate)
    ratio = math.log(rate) - math.log1p(-rate)
    total = log_term
    for i in range(rejected):
        log_term += math.log(n - i) - math.log(i + 1) + ratio
        total = max(total, log_term) + math.log1p(math.exp(-abs(total - log_term)))
    return total <= math.log(error)


@dataclass(frozen=True)
class Cutoff:
    """A rule's cutoff; good_rejected counts what all cutoffs of the stratum reject together."""

    stratum: str
    rule: str
    cutoff: float
    good: int
    good_rejected: int


def _below(rule: str, grid: tuple[float, ...]) -> Column:
    """How many of a rule's cutoffs the row's score exceeds."""
    return F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: c < F.col(rule)))


def tightening(bad: dict[str, Counter], unlabelled: dict[str, Counter]) -> list[tuple[str, int]]:
    """All (rule, grid index) in the order in which cutoffs are tightened, each rule from its loosest.

    Counters are histograms of places (how many cutoffs a score exceeds) by rule. What rejects the
    fewest unlabelled documents for each bad one comes first, both counted with one bad document at
    the stratum's own ratio added; a loose cutoff ranks with the best tighter one it leads to.
    """
    n_bad = max((c.total() for c in bad.values()), default=0)
    usual = (max((c.total() for c in unlabelled.values()), default=0) + 1) / (n_bad + 1)
    order = []
    for rule, grid in GRIDS.items():
        costs, b, u = [], 0, 0
        for k in reversed(range(len(grid))):
            b, u = b + bad.get(rule, Counter())[k + 1], u + unlabelled.get(rule, Counter())[k + 1]
            costs.append((u + usual) / (b + 1))
        best = math.inf
        for k, cost in enumerate(reversed(costs)):  # from the tightest
            best = min(best, cost)
            order.append((best, len(grid) - 1 - k, rule, k))
    return [(rule, k) for _, _, rule, k in sorted(order)]


def able_strata(good: dict[str, int], alpha: float, delta: float) -> list[str]:
    """The largest strata, as many as can share delta and still pass with no good document rejected."""
    ranked = sorted(good, key=lambda s: (-good[s], s))
    fits = [m for m in range(1, len(ranked) + 1) if bound_holds(good[ranked[m - 1]], 0, alpha, delta / m)]
    return ranked[: max(fits, default=0)]


def select_cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> list[Cutoff]:
    """Cutoffs by stratum and rule. The driver gets at most three rows for each stratum, rule and
    grid step, and then one for each stratum and step of the order."""
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("good"))
    held = measured.where(~F.col("base_failed")).join(good, "doc_id", "left")
    # How many grid steps lie below a document's score; one histogram for each stratum, label and rule.
    places = F.array(*(F.struct(F.lit(rule).alias("rule"), _below(rule, grid).alias("place")) for rule, grid in GRIDS.items()))
    rows = held.select("stratum", "good", F.explode(places).alias("p")).groupBy("stratum", "good", "p.rule", "p.place").agg(F.count("*").alias("n")).collect()
    histogram: dict[tuple, dict[str, Counter]] = {}
    for r in rows:
        histogram.setdefault((r.stratum, r.good), {}).setdefault(r.rule, Counter())[r.place] += r.n
    n_good = {s: next(iter(rules.values())).total() for (s, label), rules in histogram.items() if label == 1}
    chosen_from = able_strata(n_good, alpha, delta)
    if not chosen_from:
        return []
    orders = {s: tightening(histogram.get((s, 0), {}), histogram.get((s, None), {})) for s in chosen_from}
    # The first step that rejects a document: the least, over rules, of the step of the loosest cutoff exceeded.
    steps = {s: {rule: [step for step, (name, _) in enumerate(order) if name == rule] for rule in GRIDS} for s, order in orders.items()}
    kind = "map<string,struct<" + ",".join(f"{rule}:array<int>" for rule in GRIDS) + ">>"
    own = F.try_element_at(F.from_json(F.lit(json.dumps(steps)), kind), F.col("stratum"))
    met = [F.get(own[rule], F.size(own[rule]) - _below(rule, grid)) for rule, grid in GRIDS.items()]
    counted = held.where((F.col("good") == 1) & F.col("stratum").isin(chosen_from)).groupBy("stratum", F.least(*met).alias("step")).agg(F.count("*").alias("n")).collect()
    rejected_at: dict[str, Counter] = {}
    for r in counted:
        rejected_at.setdefault(r.stratum, Counter())[r.step] += r.n
    chosen = []
    for stratum in sorted(chosen_from):
        n, total, rejected = n_good[stratum], 0, []
        for step in range(len(orders[stratum])):
            total += rejected_at[stratum][step]
            rejected.append(total)
        # The bound only grows along the order, so bisection finds the first step that fails.
        passed = bisect_left(rejected, True, key=lambda x: not bound_holds(n, x, alpha, delta / len(chosen_from)))
        reached = {rule: GRIDS[rule][k] for rule, k in orders[stratum][:passed]}
        chosen += [Cutoff(stratum, rule, cutoff, n, rejected[passed - 1]) for rule, cutoff in sorted(reached.items())]
    return chosen


def apply_cutoffs(measured: DataFrame, cutoffs: list[Cutoff]) -> DataFrame:
    """Adds kept: no base rule and no cutoff of the row's stratum is exceeded."""
    by: dict[str, dict[str, float]] = {}
    for c in cutoffs:
        by.setdefault(c.rule, {})[c.stratum] = c.cutoff
    rejected = F.lit(False)
    for rule, limits in by.items():
        table = F.create_map(*(F.lit(x) for pair in sorted(limits.items()) for x in pair))
        rejected = rejected | F.coalesce(F.col(rule) > F.try_element_at(table, F.col("stratum")), F.lit(False))
    return measured.withColumn("kept", ~F.col("base_failed") & ~rejected)


def judge(documents: DataFrame, labels: DataFrame, stratum: str | None = "lang", alpha: float = ALPHA, delta: float = DELTA, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every document's statistics and verdict, beside the columns in carry."""
    measured = materialize(measure(documents, stratum, carry), "quality")
    return apply_cutoffs(measured, select_cutoffs(measured, labels, alpha, delta))
