"""License scan: phrases, and templates found by diagonal voting, in DataFrame expressions only.

Base labels come from places where a phrase's words stand consecutively. The method finds passages
of license templates: all rolling k-grams of a document's words are hashed and joined with the
templates' positions (a table whose size is that of the templates; Spark broadcasts it while it is
small); a hit, compared word by word, votes for its diagonal, document position minus template
position. Inserted or lost words shift the diagonal, so neighbouring diagonals are merged: they are
cut into tiles of ``SLACK`` words, or a share ``STRETCH`` of the template's words if that is more, and
each two neighbouring tiles are a window. All hits of a window lie within 1 + 2 * STRETCH times the
template's length, whatever else the document holds, so a passage is never lost to other hits, and
a window's size does not grow with the document. A span is verified in order: of the window's
segments (neighbouring hits of one diagonal) the chain that goes forward in the template and in the
document and covers most of the template counts, each word once on either side; it must cover at
least ``LEAST`` of the template. Where spans overlap by half or more, the one that covers more
words stays, so a text that contains most of a shorter template is not labelled with that too.

Repeated rows change nothing: hits are sets by (document, template, diagonal). Rows are matched to
their hits by doc_id and a hash of the text, so rows that share a doc_id keep their own results.

Defined results: null text is empty: no words, no labels, score 0; texts of any length are scanned
whole. Score: the largest covered share of a template, 1 where a base phrase stands. Extra columns
are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm.license_texts import TEXTS
from concordat.llm.quality import bind

#: The contract's phrases and labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Template passages with their labels.
TEMPLATES = TEXTS
K = 3
SLACK = 2
STRETCH = 0.25
LEAST = 0.6
#: Up to so many hashes of templates stand in the filter as literals; more are left to the join.
MOST_LITERALS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of letters, digits and everything beyond ASCII."""
    flat = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def phrase_places(words: Column, phrases: Mapping[str, str] = PHRASES) -> Column:
    """Array of (start, label): every place of every phrase."""
    return F.concat(*(_places(words, *phrase.split(" "), label=label) for phrase, label in phrases.items()))


def _places(words: Column, first: str, *rest: str, label: str) -> Column:
    def here(x: Column, i: Column) -> Column:
        test = x == first
        for j, word in enumerate(rest, 1):
            test = test & F.coalesce(F.get(words, i + j) == word, F.lit(False))
        return F.when(test, i)

    at = F.filter(F.transform(words, here), lambda i: i.isNotNull())
    found = F.transform(at, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))
    return F.when(F.array_contains(words, first), found).otherwise(F.array().cast("array<struct<start:bigint,label:string>>"))


def _grams(words: Column, k: int) -> Column:
    """(position, hash) of all rolling k-grams."""
    at = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - k + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct((i - 1).alias("pos"), F.xxhash64(F.slice(words, i, F.lit(k))).alias("hash")))


def template_positions(spark: SparkSession, templates: Mapping[str, str] = TEMPLATES, k: int = K) -> DataFrame:
    """template, n (its words), tpos, hash and words of every k-gram of every template."""
    rows = F.array(*(F.struct(F.lit(label).alias("template"), F.lit(text).alias("text")) for label, text in templates.items()))
    named = spark.range(1).select(F.explode(rows).alias("t")).select("t.template", words_of(F.col("t.text")).alias("w"))
    return named.select("template", F.size("w").alias("n"), "w", F.explode(bind(F.col("w"), lambda w: _grams(w, k))).alias("g")).select("template", "n", F.col("g.pos").alias("tpos"), F.col("g.hash").alias("hash"), F.slice("w", F.col("g.pos") + 1, F.lit(k)).alias("twords"))


def vote(documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, k: int = K, slack: int = SLACK, least: float = LEAST) -> DataFrame:
    """Verified spans: doc_id, text_hash, template, start, end (words), words and share of the template covered."""
    words = documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words_of(F.col("text")).alias("w"))
    positions = template_positions(documents.sparkSession, templates, k)
    # Grams whose hash no template has are left out inside the row; of the others the words go along for comparison.
    hashes = positions.agg(F.collect_set("hash").alias("h")).first().h
    known = lambda g: g["hash"].isin(hashes) if len(hashes) <= MOST_LITERALS else F.lit(True)
    met = lambda w: F.transform(F.filter(_grams(w, k), known), lambda g: F.struct(g["pos"].alias("pos"), g["hash"].alias("hash"), F.slice(w, g["pos"] + 1, F.lit(k)).alias("own")))
    own = words.select("doc_id", "text_hash", F.explode(bind(F.col("w"), met)).alias("g")).select("doc_id", "text_hash", F.col("g.pos").alias("pos"), F.col("g.hash").alias("hash"), F.col("g.own").alias("own"))
    hits = own.join(positions, "hash").where(F.col("own") == F.col("twords"))
    votes = hits.groupBy("doc_id", "text_hash", "template", "n", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("tposes"))
    # Maximal stretches of neighbouring hits of a diagonal: template words t0 to t1 stand at p0 to p1.
    ends = lambda step: F.array_sort(F.filter("tposes", lambda t: ~F.array_contains("tposes", t + step)))
    piece = lambda t, u: F.struct(t.alias("t0"), (t + F.col("diagonal")).alias("p0"), (u + k).alias("t1"), (u + F.col("diagonal") + k).alias("p1"))
    reach = F.greatest(F.lit(slack), F.floor(F.col("n") * STRETCH).cast("int"))
    tile = F.floor(F.col("diagonal") / reach)
    windows = votes.select("doc_id", "text_hash", "template", "n", F.explode(F.array(tile - 1, tile)).alias("window"), F.zip_with(ends(-1), ends(1), piece).alias("pieces"))
    spans = windows.groupBy("doc_id", "text_hash", "template", "n", "window").agg(F.array_sort(F.flatten(F.collect_list("pieces"))).alias("pieces"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("pieces", lambda x: F.sequence(x["t0"], x["t1"] - 1)))))
    best = spans.where(covered >= least * F.col("n")).select("doc_id", "text_hash", "template", "n", longest_chain(F.col("pieces")).alias("s"))
    found = best.select("doc_id", "text_hash", "template", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.words").alias("words"), (F.col("s.words") / F.col("n")).alias("share"))
    return found.where(F.col("share") >= least)


def longest_chain(pieces: Column) -> Column:
    """(words, start, end) of the chain of pieces (t0, p0, t1, p1; sorted) that covers most template words.

    A piece continues another one that begins no later and ends earlier on both sides; what both cover on
    either side counts once. Among equal chains the one that starts first is taken.
    """
    link = "struct<t0:int,p0:int,t1:int,p1:int,words:int,start:int>"

    def add(done: Column, x: Column) -> Column:
        before = F.filter(done, lambda y: (y["p0"] <= x["p0"]) & (y["t1"] < x["t1"]) & (y["p1"] < x["p1"]))
        gain = lambda y: F.least(x["t1"] - F.greatest(x["t0"], y["t1"]), x["p1"] - F.greatest(x["p0"], y["p1"]))
        totals = F.transform(before, lambda y: F.struct((y["words"] + gain(y)).alias("words"), (-y["start"]).alias("back")))
        alone = F.struct((x["t1"] - x["t0"]).alias("words"), (-x["p0"]).alias("back"))
        own = bind(F.array_max(F.concat(F.array(alone), totals)), lambda m: F.struct(x["t0"].alias("t0"), x["p0"].alias("p0"), x["t1"].alias("t1"), x["p1"].alias("p1"), m["words"].alias("words"), (-m["back"]).alias("start")))
        return F.concat(done, F.array(own))

    chains = F.reduce(pieces, F.array().cast(f"array<{link}>"), add)
    top = F.array_max(F.transform(chains, lambda y: F.struct(y["words"].alias("words"), (-y["start"]).alias("back"), y["p1"].alias("end"))))
    return bind(top, lambda m: F.struct(m["words"].alias("words"), (-m["back"]).alias("start"), m["end"].alias("end")))


def without_covered(spans: Column) -> Column:
    """Spans (start, end, template, share, words) of which no other covers half or more and has more words of its template."""
    rank = lambda x: F.struct(x["words"], x["share"], -x["start"], x["template"])
    common = lambda x, y: F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"])
    return F.filter(spans, lambda x: ~F.exists(spans, lambda y: (2 * common(x, y) >= x["end"] - x["start"]) & (rank(y) > rank(x))))


def scan(documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    base = documents.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        bind(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), phrase_places(w, phrases).alias("places"))).alias("f"),
    )
    spans = F.sort_array(F.collect_set(F.struct("start", "end", "template", "share", "words")))
    found = vote(documents, templates).groupBy("doc_id", "text_hash").agg(spans.alias("every")).withColumn("spans", without_covered(F.col("every")))
    # Null doc_ids match their hits too.
    joined = base.alias("b").join(found.alias("f2"), F.col("b.doc_id").eqNullSafe(F.col("f2.doc_id")) & (F.col("b.text_hash") == F.col("f2.text_hash")), "left")
    places = F.col("b.f.places")
    labels = F.array_distinct(F.transform(places, lambda p: p["label"]))
    text = lambda a: F.array_join(F.array_sort(a), ",")
    return joined.select(
        F.col("b.doc_id").alias("doc_id"), F.col("b.f.n").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["start"])).alias("last_word"),
        text(labels).alias("base_labels"),
        text(F.array_distinct(F.concat(labels, F.coalesce(F.transform("f2.spans", lambda x: x["template"]), F.array().cast("array<string>"))))).alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("f2.spans", lambda x: x["share"])), F.lit(0.0))).cast("double").alias("score"),
        F.col("f2.spans").alias("spans"),
    )
