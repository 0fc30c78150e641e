"""Secret scan: candidates by pattern, false positives removed by a random forest; DataFrame expressions only.

Candidates are runs of 16 or more letters, digits and ``_+/-`` (with dots between parts and base64
padding), whole private key blocks (PGP ones too, with their header lines), the password in
``://user:password@``, and, right after a word like ``password`` with ``=``, ``:`` or ``is``, values of 6 or more characters. Whatever stands in a candidate, the forest decides. Its features are
the length, the changes of character class along the candidate, the shares of digits, capitals,
other marks, distinct characters, of characters that dictionary words cover and of letter pairs that
are usual in words, whether it looks like a path, an identifier, a placeholder or a key as issuers
mark them, and the words beside it. The forest is trained on the driver from labelled findings (at most ``most_findings``
rows, a documented bound; a table of them, or by default findings made here from a seed), and
becomes one SQL expression, so scanning stays inside the row: no text is shuffled and no Python runs
on executors.

Texts are split at their candidates once; places come from sums over blocks of ``BLOCK`` candidates
and the redacted text from joining the parts again, so texts of any length and number of candidates
are scanned whole, in time that grows with them.

Defined results: null text has no candidates and stays null when redacted; an empty text has none
and stays empty; repeated rows each get their row; ties don't arise, because candidates don't
overlap; an empty table gives an empty one; extra columns are ignored by ``scan`` and kept by
``redact``, whatever they are called.
"""

from __future__ import annotations

import base64
import json
import random
import string
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm.quality import bind

KEYWORDS = ("token", "secret", "password", "passwd", "pwd", "passphrase", "pass", "pw", "kennwort", "contraseña", "api_key", "apikey", "api-key", "api key", "access key", "access_key", "auth", "bearer", "credential", "private key", "client_secret")
#: Java patterns; runs are possessive, so that they never backtrack over long texts.
RUN = r"(?<![A-Za-z0-9_+/.\-])(?=[A-Za-z0-9_+/.\-]{16})[A-Za-z0-9_+/\-]++(?:\.[A-Za-z0-9_+/\-]++)*+={0,2}"
KEY_BLOCK = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----(?:(?!-----END )[\x20-\x7E\s])*+-----END [A-Z ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
ASSIGNED = "(?i:" + "|".join(KEYWORDS) + r")[\"']?\s{0,2}(?:[=:]|is\s)\s{0,2}[\"']?"
#: The password of user:password@host in an address; the first lookbehind spares the second one nearly everywhere.
USERINFO = r"(?<=:)(?<=://[A-Za-z0-9._%+\-]{1,40}:)[^\s@/:\"'<>]{3,64}+(?=@)"
#: Keys that their issuers mark: fixed prefixes and lengths.
ISSUED = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[oprsu]_[A-Za-z0-9]{30,}$|^github_pat_[A-Za-z0-9_]{20,}$|^[sr]k_(live|test)_[A-Za-z0-9]{16,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^AIza[A-Za-z0-9_-]{30,}$|^glpat-[A-Za-z0-9_-]{16,}$|^eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*$"
VALUE = r"[^\s\"'`,;<>(){}\[\]]{6,}+"
#: Texts in which a keyword is assigned something are scanned by the wider pattern, others can't have its values.
WIDE = f"{KEY_BLOCK}|{USERINFO}|(?<=[\"'=:\\s])(?<={ASSIGNED}){VALUE}|{RUN}"
NARROW = f"{KEY_BLOCK}|{USERINFO}|{RUN}"
AROUND = 48
BLOCK = 256
MARK = "[SECRET]"
#: Words whose letters don't speak for a random string.
DICTIONARY = (
    "user", "name", "file", "home", "local", "share", "library", "system", "windows", "program", "temp", "source", "main", "test", "data",
    "image", "static", "assets", "version", "release", "build", "python", "java", "node", "index", "page", "report", "chapter", "section", "model",
    "config", "default", "example", "sample", "order", "number", "date", "time", "year", "month", "week", "the", "and", "for", "with", "from", "this", "that",
    "which", "there", "their", "about", "would", "other", "after", "first", "where", "being", "under", "while", "should", "through", "between", "because",
    "people", "world", "state", "group", "company", "country", "problem", "question", "market", "service", "server", "client", "module", "package",
    "vendor", "public", "private", "docs", "readme", "install", "update", "branch", "feature", "issue", "ticket", "http", "https", "html", "json", "cache",
    "backup", "message", "account", "address", "number", "value", "field", "table", "record", "string", "object", "class", "method", "function", "return",
    "request", "response", "session", "context", "handler", "manager", "factory", "controller", "component", "interface", "application", "information",
    "environment", "development", "production", "international", "organisation", "responsibility", "administration", "communication", "characteristic",
    "internet", "network", "database", "security", "key", "input", "output", "result", "parameter", "variable", "required", "optional", "unknown",
    "ing", "tion", "ment", "able", "ence", "ance", "ness", "ical", "ously", "ation", "lich", "keit", "ung", "schaft", "ción", "mente", "eux", "ement",
)
#: Letter pairs of two or more of these words.
PAIRS = tuple(sorted(pair for pair, n in Counter(p for w in set(DICTIONARY) for p in {w[i : i + 2] for i in range(len(w) - 1)}).items() if n > 1 and pair.isascii()))
BENIGN = ("commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "uuid", "guid", "etag", "revision", "build", "isbn", "order", "id", "version", "file", "path", "image", "integrity")
FEATURES = (
    "length", "changes", "digits", "capitals", "marks", "distinct", "dictionary", "pairs", "hexadecimal", "path", "keyword", "assigned", "quoted", "benign", "placeholder", "uuid", "block", "issued", "userinfo",
)
THRESHOLD = 0.5
TREES, DEPTH, SEED = 21, 8, 7


def _starts(steps: Column) -> Column:
    """Running sums of steps: first of blocks, then within each block."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))
    add = lambda s, x: s + x
    zero = F.lit(0).cast("bigint")

    def within(bs: Column, sums: Column) -> Column:
        base = lambda b: F.reduce(F.slice(sums, F.lit(1), b), zero, add)
        inner = lambda block, before: F.transform(F.sequence(F.lit(1), F.size(block)), lambda j: before + F.reduce(F.slice(block, F.lit(1), j), zero, add))
        return F.flatten(F.transform(bs, lambda block, b: bind(base(b), lambda before: inner(block, before))))

    return bind(blocks, lambda bs: bind(F.transform(bs, lambda block: F.reduce(block, zero, add)), lambda sums: within(bs, sums)))


def split_up(text: Column) -> Column:
    """Struct of parts (the text between candidates) and found: (start, candidate, before, after), start from 0; null without candidates."""

    def build(pattern: str) -> Column:
        def places(x: Column) -> Column:
            steps = F.transform(x["cands"], lambda c, i: (F.length(F.get(x["parts"], i)) + F.coalesce(F.length(F.get(x["cands"], i - 1)), F.lit(0))).cast("bigint"))
            return bind(bind(steps, _starts), lambda starts: F.struct(x["parts"].alias("parts"), F.transform(x["cands"], lambda c, i: F.struct(
                F.get(starts, i).alias("start"), c.alias("candidate"),
                F.right(F.get(x["parts"], i), F.lit(AROUND)).alias("before"), F.left(F.get(x["parts"], i + 1), F.lit(AROUND)).alias("after"),
            )).alias("found")))

        both = F.struct(F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("cands"))
        return F.when(text.rlike(pattern), bind(both, places))

    return F.when(text.rlike(ASSIGNED), build(WIDE)).otherwise(build(NARROW))


def _any_of(words: Sequence[str]) -> str:
    return "(" + "|".join(words) + ")"


def features(c: Column) -> Column:
    """Struct of doubles, named FEATURES, of one candidate struct."""
    text, before = c["candidate"], F.lower(c["before"])
    low = F.lower(text)
    size = F.length(text)
    share = lambda n, of=size: (n / F.greatest(of, F.lit(1))).cast("double")
    flag = lambda test: F.when(test, 1.0).otherwise(0.0)
    without = lambda chars: size - F.length(F.translate(text, chars, ""))
    classes = F.translate(text, string.ascii_lowercase + string.ascii_uppercase + string.digits, "a" * 26 + "A" * 26 + "0" * 10)
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    uncovered = F.length(F.regexp_replace(low, _any_of(sorted(set(DICTIONARY), key=lambda w: (-len(w), w))), ""))
    letter_pairs = F.regexp_count(low, F.lit("(?=[a-z]{2})"))
    near = r"[\s\"'`:=>\(\[_-]{0,6}(is|was|of)?[\s\"'`:=>\(\[]{0,6}$"
    return F.struct(
        size.cast("double").alias("length"),
        share(runs - 1).alias("changes"),
        share(without(string.digits)).alias("digits"),
        share(without(string.ascii_uppercase)).alias("capitals"),
        share(F.length(F.translate(text, string.ascii_letters + string.digits, ""))).alias("marks"),
        share(F.size(F.array_distinct(F.split(text, "")))).alias("distinct"),
        share(size - uncovered).alias("dictionary"),
        share(F.regexp_count(low, F.lit("(?=" + _any_of(PAIRS) + ")")), letter_pairs).alias("pairs"),
        flag(text.rlike("^[0-9a-fA-F]+$")).alias("hexadecimal"),
        flag(before.rlike(r"(://\S*|[/.\\])$") | c["after"].rlike(r"^[/\\.][a-zA-Z]") | (without("/") >= 3)).alias("path"),
        flag(before.rlike(_any_of(KEYWORDS) + near)).alias("keyword"),
        flag(before.rlike(r"[=:]\s*[\"'`]?$")).alias("assigned"),
        flag(before.rlike(r"[\"'`]$") & c["after"].rlike(r"^[\"'`]")).alias("quoted"),
        flag(before.rlike(r"\b" + _any_of(BENIGN) + near) | c["after"].rlike("^[@(\\[]") | before.rlike("@$")).alias("benign"),
        flag(low.rlike("example|sample|dummy|placeholder|change.?me|xxxx|your[_-]|0{6,}|123456|\\$\\{|\\*{4}")).alias("placeholder"),
        flag(low.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")).alias("uuid"),
        flag(text.startswith("-----BEGIN")).alias("block"),
        flag(text.rlike(ISSUED)).alias("issued"),
        flag(before.rlike(r"://[a-z0-9._%+\-]{1,40}:$") & c["after"].startswith("@")).alias("userinfo"),
    )


@dataclass(frozen=True)
class Finding:
    before: str
    candidate: str
    after: str
    secret: bool


def _kinds(rng: random.Random) -> tuple[dict[str, Callable[[], tuple[str, str]]], dict[str, Callable[[], tuple[str, str, str]]]]:
    """How secrets (candidate, usual quote) and harmless strings (before, candidate, after) of each kind are made."""
    pick = lambda alphabet, size: "".join(rng.choices(alphabet, k=size))
    word, hexes, full = (lambda: rng.choice(DICTIONARY)), "0123456789abcdef", string.ascii_letters + string.digits
    syllables = lambda n: "".join(rng.choice("bcdfghklmnprstvwz") + rng.choice("aeiou") + rng.choice(["", "n", "r", "s", "st", "l"]) for _ in range(n))
    b64 = lambda low, high: base64.b64encode(rng.randbytes(rng.randint(low, high))).decode()
    plain = lambda n: "".join(w for w in (word() for _ in range(n)) if w.isascii())
    secret = {
        "hex": lambda: (pick(hexes, rng.choice([32, 40, 40, 64])), ""),
        "aws": lambda: ("AKIA" + pick(string.ascii_uppercase + string.digits, 16), ""),
        "alphanumeric": lambda: (pick(full, rng.randint(20, 64)), ""),
        "base64": lambda: (b64(18, 48), ""),
        "prefixed": lambda: (rng.choice(["sk_live_", "ghp_", "gho_", "ghs_", "xoxb-", "xoxp-", "AIza", "glpat-"]) + pick(full, 36), ""),
        "userinfo": lambda: (pick(full, rng.randint(5, 20)) if rng.random() < 0.5 else word() + str(rng.randint(1, 999)), "@"),
        "password": lambda: (pick(string.ascii_lowercase * 2 + full + "!@#%&*+-_?" * rng.randint(0, 2), rng.randint(7, 20)), ""),
        "phrase": lambda: (plain(rng.randint(3, 5)) + syllables(1) + rng.choice(["", str(rng.randint(1, 99)), "!"]), '"'),
        "letters": lambda: ("".join(rng.sample(string.ascii_lowercase, rng.randint(16, 26))) if rng.random() < 0.6 else string.ascii_lowercase, '"'),
        "parts": lambda: ("eyJ" + ".".join(pick(full + "_-", rng.randint(20, 80)) for _ in range(3)), ""),
        "block": lambda: (rng.choice(["-----BEGIN RSA PRIVATE KEY-----\n", "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 1\n\n"]) + b64(rng.choice([6, 30, 200]), 400) + "\n-----END RSA PRIVATE KEY-----", ""),
    }
    harmless = {
        "digest": lambda: (rng.choice(BENIGN) + rng.choice([" ", ": ", "="]), pick(hexes, rng.choice([32, 40, 64])), ""),
        "uuid": lambda: (rng.choice(["id ", "", "uuid: ", 'id="']), str(uuid.UUID(int=rng.getrandbits(128))), ""),
        "path": lambda: (rng.choice(["/", "", "path "]), "/".join(word() for _ in range(rng.randint(3, 6))) + str(rng.randint(0, 99)), ""),
        "number": lambda: (rng.choice(["order ", "", "isbn ", "number "]), pick(string.digits, rng.randint(16, 24)), ""),
        "snake": lambda: ("", rng.choice("_-").join(word() for _ in range(rng.randint(3, 5))) + rng.choice(["", "_" + str(rng.randint(1, 2030))]), ""),
        "placeholder": lambda: (rng.choice(KEYWORDS) + ' = "', rng.choice(["your-token-goes-here-1", "xxxxxxxxxxxxxxxx1234", "example-api-key-0000", "changeme-changeme-12345", "0000000000000000000000"]), '"'),
        "address": lambda: (f"https://{word()}.example.com/", pick(full, rng.randint(16, 40)), "/" + word()),
        "image": lambda: (rng.choice(["data:image/png;base64,", "", "body: "]), b64(200, 600), ""),
        "prose": lambda: (rng.choice(["", "the ", "und ", "de "]), syllables(rng.randint(5, 9))[: rng.randint(16, 30)], rng.choice(["", ",", "."])),
        "shout": lambda: ("", syllables(rng.randint(5, 9)).upper(), rng.choice(["", "!!"])),
        "sentences": lambda: ("", syllables(3) + "." + syllables(4).capitalize() + "." + syllables(2), ""),
        "camel": lambda: (rng.choice(["", "class ", "new "]), "".join(word().capitalize() for _ in range(rng.randint(3, 5))), rng.choice(["", "(", "()"])),
        "domain": lambda: (rng.choice(["", "www.", "@", "https://"]), f"{word()}{rng.randint(1, 99)}.{word()}.example.com", ""),
        "mailbox": lambda: ("", f"{syllables(2)}.{rng.randint(1, 99)}", "@mail.example.com"),
        "code": lambda: (rng.choice(KEYWORDS) + rng.choice([" = ", "=", ": "]), word() + "." + word() + "_" + word(), rng.choice(["(", "[", ")", ";"])),
        "remark": lambda: (rng.choice(KEYWORDS) + rng.choice([": ", " is ", " is "]), rng.choice([word(), syllables(3)]), rng.choice([" ", ". ", ", "])),
    }
    return secret, harmless


def made_findings(n: int = 4000, seed: int = SEED, without: Sequence[str] = (), only: Sequence[str] = ()) -> list[Finding]:
    """Labelled findings from a seed: keys as services issue them and people choose them, and strings
    that merely look like them; of all kinds, of all but some, or of some only."""
    rng = random.Random(seed)
    chosen = [{k: make for k, make in own.items() if k not in without and (not only or k in only)} for own in _kinds(rng)]
    filler = lambda: " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(4)) + " "
    out = []
    for i in range(n):
        if i % 2 and chosen[0]:
            value, quote = rng.choice(list(chosen[0].values()))()
            key, sign = rng.choice(KEYWORDS), rng.choice([" = ", "=", ": ", " is ", ":"])
            quote = quote or rng.choice(['"', "'", "", ""])
            before = filler() + rng.choice(["", "my ", "the ", "aws_", "aws_secret_", "db_", "x-"]) + key + sign + quote
            if value.startswith("-----") or rng.random() < 0.4 and value.startswith(("AKIA", "gh", "sk_", "xox", "eyJ", "AIza", "glpat-")):
                before, quote = filler(), ""
            if quote == "@":
                before, quote = filler() + rng.choice(["https://", "postgres://", "ftp://"]) + rng.choice([*DICTIONARY[:60], "admin", "root"]) + ":", "@" + rng.choice(DICTIONARY) + ".example.com/"
            out.append(Finding(before, value, quote + " " + filler(), True))
        elif not i % 2 and chosen[1]:
            before, value, after = rng.choice(list(chosen[1].values()))()
            out.append(Finding(filler() + before, value, after + " " + filler(), False))
    return out


def _grow(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator):
    """A tree as nested tuples (feature, cut, left, right), or the share of secrets in a leaf."""
    share = float(y.mean())
    if depth == 0 or len(y) < 8 or share in (0.0, 1.0):
        return share
    best = (1e-9, None, None)
    gini = lambda p: 2 * p * (1 - p)
    for f in rng.choice(x.shape[1], size=6, replace=False):
        values = np.unique(x[:, f])
        cuts = (values[1:] + values[:-1]) / 2
        for cut in cuts if len(cuts) <= 32 else cuts[np.linspace(0, len(cuts) - 1, 32).astype(int)]:
            left = x[:, f] <= cut
            n = left.sum()
            if 4 <= n <= len(y) - 4:
                gain = gini(share) - (n * gini(y[left].mean()) + (len(y) - n) * gini(y[~left].mean())) / len(y)
                if gain > best[0]:
                    best = (gain, int(f), float(cut))
    _, f, cut = best
    if f is None:
        return share
    left = x[:, f] <= cut
    return f, cut, _grow(x[left], y[left], depth - 1, rng), _grow(x[~left], y[~left], depth - 1, rng)


def train_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> list:
    rng = np.random.default_rng(seed)
    forest = []
    for _ in range(trees):
        own = rng.integers(0, len(y), len(y))
        forest.append(_grow(x[own], y[own], depth, rng))
    return forest


def _vote(forest: list, f: Column) -> Column:
    """The forest's mean vote over a struct of features."""

    def tree(t) -> Column:
        if not isinstance(t, tuple):
            return F.lit(t)
        at, cut, left, right = t
        return F.when(f[FEATURES[at]] <= cut, tree(left)).otherwise(tree(right))

    total = tree(forest[0])
    for t in forest[1:]:
        total = total + tree(t)
    return (total / len(forest)).cast("double")


def labelled_features(spark: SparkSession, findings: DataFrame | Sequence[Finding], most_findings: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of labelled findings, by the same expressions that scan texts; of a larger table a fixed sample."""
    if isinstance(findings, DataFrame):
        chosen = findings.orderBy(F.xxhash64("before", "candidate", "after"), "before", "candidate", "after").limit(most_findings)
        rows = chosen.select(F.struct("candidate", F.right("before", F.lit(AROUND)).alias("before"), F.left("after", F.lit(AROUND)).alias("after")).alias("c"), F.col("secret").cast("boolean").alias("secret"))
    else:
        findings = list(findings) if len(findings) <= most_findings else random.Random(SEED).sample(list(findings), most_findings)
        text = json.dumps([{"candidate": f.candidate, "before": f.before[-AROUND:], "after": f.after[:AROUND], "secret": f.secret} for f in findings])
        kind = "array<struct<candidate:string,before:string,after:string,secret:boolean>>"
        rows = spark.range(1).select(F.explode(F.from_json(F.lit(text), kind)).alias("c")).select("c", "c.secret")
    found = rows.select(features(F.col("c")).alias("f"), "secret").collect()
    return np.array([[r.f[name] for name in FEATURES] for r in found]), np.array([float(r.secret) for r in found])


def fit(spark: SparkSession, findings: DataFrame | Sequence[Finding] | None = None, most_findings: int = 20_000) -> list:
    """The forest of labelled findings: a table with before, candidate, after, secret, or a sequence."""
    return train_forest(*labelled_features(spark, _default_findings() if findings is None else findings, most_findings))


@lru_cache(maxsize=1)
def _default_findings() -> tuple[Finding, ...]:
    return tuple(made_findings())


def _judged(text: Column, forest: list, threshold: float) -> Column:
    """Struct of n (candidates), secrets (start, length, score) and redacted, for a text; null without candidates."""
    def verdicts(x: Column) -> Column:
        scored = F.transform(x["found"], lambda c: bind(features(c), lambda f: F.struct(c["start"].alias("start"), F.length(c["candidate"]).cast("bigint").alias("length"), _vote(forest, f).alias("score"), c["candidate"].alias("candidate"))))
        return bind(scored, lambda s: F.struct(
            F.size(s).cast("bigint").alias("n"),
            F.transform(F.filter(s, lambda c: c["score"] >= threshold), lambda c: F.struct(c["start"].alias("start"), c["length"].alias("length"), c["score"].alias("score"))).alias("secrets"),
            F.array_join(F.zip_with(x["parts"], s, lambda p, c: F.concat(p, F.when(c.isNull(), "").when(c["score"] >= threshold, MARK).otherwise(c["candidate"]))), "").alias("redacted"),
        ))

    return bind(split_up(text), lambda x: F.when(x.isNotNull(), verdicts(x)))


def scan(documents: DataFrame, findings: DataFrame | Sequence[Finding] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_candidates, n_secrets, secrets (start, length, score), redacted text."""
    judged = documents.select("doc_id", "text", _judged(F.col("text"), fit(documents.sparkSession, findings), threshold).alias("j"))
    secrets = F.coalesce("j.secrets", F.array().cast("array<struct<start:bigint,length:bigint,score:double>>"))
    return judged.select("doc_id", F.coalesce("j.n", F.lit(0).cast("bigint")).alias("n_candidates"), F.size(secrets).cast("long").alias("n_secrets"), secrets.alias("secrets"), F.coalesce("j.redacted", "text").alias("redacted"))


def redact(documents: DataFrame, findings: DataFrame | Sequence[Finding] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """documents, every row and column kept, with secrets in ``text`` replaced by the mark; ``n_chars`` is counted anew."""
    forest = fit(documents.sparkSession, findings)
    every = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")
    done = documents.select(every, F.coalesce(_judged(F.col("text"), forest, threshold)["redacted"], F.col("text")).alias("text"))
    fresh = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*(fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in documents.columns))
