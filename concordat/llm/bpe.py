"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

Texts are cut into words by the tokenizer's pattern. Distinct words not seen before are inserted
into a trie of their bytes, which is walked depth first. A node's state is the last token of the
encoding of its prefix: of the tokens that are suffixes of the prefix, the one that may follow the
state at the node where the suffix starts. A word's encoding is read by following states back from
its node, so shared prefixes are encoded once. Two tokens may stand side by side iff no merge
across their border would have been applied while both border pieces existed; that is checked
along the right spine of the left token's merge tree and the left spine of the right one's.

Encoded words are kept per Python worker up to ``CACHE_WORDS``; the cache is emptied when full,
which costs time, never results. Words beyond ``TRIE_BYTES`` bytes run along their own path only.

Defined results: a null text is empty (no ids). Special tokens in a text are found as the library
does by default: their strings become their ids. Repeated rows each get their row.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_WORDS = 1_000_000
GROUP_CHARS = 2_000_000
TRIE_BYTES = 256


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _unsettled() -> re.Pattern:
    """Characters that Unicode 3.2 did not know, and all beyond the basic plane."""
    old, runs = unicodedata.ucd_3_2_0, []
    for c in range(0x10000):
        if old.category(chr(c)) == "Cn":
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
    return re.compile("[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs) + "\\U00010000-\\U0010ffff]")


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = dict.fromkeys(self.bytes_of, -1)
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            self.rank[a, b] = r
            self.parts.setdefault(whole, (a, b))
            self.made[whole] = r if self.parts[whole] == (a, b) else self.made[whole]
        self.sizes = {i: len(b) for i, b in self.bytes_of.items()}
        self.spines: tuple[dict, dict] = ({}, {})
        self._link_suffixes()
        self.words = regex.compile(PATTERN)
        self.unsettled = _unsettled()
        self.library = None
        self.cache: dict[str, bytes] = {}
        self.may: dict[int, bool] = {}
        self.decoded = dict(self.bytes_of) | {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _link_suffixes(self) -> None:
        """Automaton over the tokens' bytes: step (node and byte -> node), where to fall back, and
        each node's longest token that is a suffix; shorter[token]: the next shorter such token."""
        self.step: dict[int, int] = {}
        ends, nodes = [-1], 1
        at: dict[bytes, int] = {b"": 0}
        for data, token in sorted(self.id_of.items()):
            node = 0
            for i, b in enumerate(data):
                nxt = self.step.get(node << 8 | b)
                if nxt is None:
                    nxt = self.step[node << 8 | b] = nodes
                    at[data[: i + 1]] = nodes
                    nodes += 1
                    ends.append(-1)
                node = nxt
            ends[node] = token
        self.back, self.best, self.shorter = [0] * nodes, ends, {}
        for path, node in sorted(at.items(), key=lambda x: len(x[0])):
            if not path:
                continue
            up = at[path[:-1]]
            fall = self._move(self.back[up], path[-1]) if up else 0
            self.back[node] = fall
            if ends[node] >= 0:
                self.shorter[ends[node]] = self.best[fall]
            else:
                self.best[node] = self.best[fall]

    def _move(self, node: int, b: int) -> int:
        nxt = self.step.get(node << 8 | b)
        while nxt is None and node:
            node = self.back[node]
            nxt = self.step.get(node << 8 | b)
        return nxt or 0

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces at a token's border with the rank of the merge that ends each, outermost first."""
        known = self.spines[side].get(token)
        if known is None:
            known, piece, ends = [(token, float("inf"))], token, self.made[token]
            while piece in self.parts:
                piece = self.parts[piece][side]
                known.append((piece, ends))
                ends = self.made[piece]
            self.spines[side][token] = known
        return known

    def may_follow(self, a: int, b: int) -> bool:
        """Whether BPE leaves a and b side by side."""
        right, rank = self._spine(b, 0), self.rank
        known = True
        for x, x_ends in self._spine(a, 1):
            for y, y_ends in right:
                r = rank.get((x, y))
                # Of merges with one rank the leftmost goes first: the one inside a, then the one across.
                if r is not None and r < x_ends and r <= y_ends:
                    known = False
        if len(self.may) > 4 * CACHE_WORDS:
            self.may.clear()
        self.may[a << 20 | b] = known
        return known

    def _state(self, node: int, n: int, states: list[int]) -> int:
        """The last token of the encoding of a prefix of n bytes that led to the automaton's node;
        states[i]: that of its first i bytes."""
        token, may, sizes = self.best[node], self.may, self.sizes
        while True:
            size = sizes[token]
            if size == n:
                if self._whole(token):
                    return token
            else:
                before = states[n - size]
                fits = may.get(before << 20 | token)
                if fits is None:
                    fits = self.may_follow(before, token)
                if fits:
                    return token
            token = self.shorter[token]

    @lru_cache(maxsize=None)  # noqa: B019  one tokenizer lives as long as the worker
    def _whole(self, token: int) -> bool:
        """Whether the token's bytes encode to the token itself."""
        if token not in self.parts:
            return len(self.bytes_of[token]) == 1
        a, b = self.parts[token]
        if not (self._whole(a) and self._whole(b)):
            return False
        # a and b must survive until their own merge: nothing across may come before it.
        r = self.made[token]
        return not any((m := self.rank.get((x, y))) is not None and m < r and m < xe and m <= ye for x, xe in self._spine(a, 1) for y, ye in self._spine(b, 0))

    def _ids(self, states: list[int], n: int) -> bytes:
        out = []
        while n:
            out.append(states[n])
            n -= self.sizes[states[n]]
        return np.array(out[::-1], dtype="<u4").tobytes()

    def _learn(self, words: Iterable[str]) -> None:
        """Encode words into the cache: trie, then one depth-first walk."""
        root: dict = {}
        for word in words:
            data = word.encode()
            if len(data) > TRIE_BYTES:
                states, at = [-1], 0
                for n, b in enumerate(data, 1):
                    at = self._move(at, b)
                    states.append(self._state(at, n, states))
                self.cache[word] = self._ids(states, len(data))
                continue
            node = root
            for b in data:
                node = node.setdefault(b, {})
            node[-1] = word
        states, places = [-1], [0]
        stack = [iter(root.items())]
        step, back, best, shorter, sizes, may = self.step, self.back, self.best, self.shorter, self.sizes, self.may
        while stack:
            for b, node in stack[-1]:
                if b == -1:
                    self.cache[node] = self._ids(states, len(states) - 1)
                    continue
                # As _move() and _state(), in place: this is the inner loop.
                at = places[-1]
                nxt = step.get(at << 8 | b)
                while nxt is None and at:
                    at = back[at]
                    nxt = step.get(at << 8 | b)
                at, n = nxt or 0, len(places)
                token = best[at]
                while (size := sizes[token]) == n or not (fits if (fits := may.get(states[n - size] << 20 | token)) is not None else self.may_follow(states[n - size], token)):
                    if size == n and self._whole(token):
                        break
                    token = shorter[token]
                places.append(at)
                states.append(token)
                stack.append(iter(node.items()))
                break
            else:
                stack.pop()
                places.pop()
                states.pop()

    def _library_words(self, piece: str) -> list[str]:
        """The library's own cut, for characters whose class Unicode versions disagree on."""
        if self.library is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.library = ByteLevel(add_prefix_space=False)
        return [piece[a:b] for _, (a, b) in self.library.pre_tokenize_str(piece)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def _cut(self, text: str) -> list[str]:
        """The pattern's words."""
        return self.words.findall(text) if text.isascii() or not self.unsettled.search(text) else self._library_words(text)

    def _codes(self, cut: list[list[str]]) -> list[bytes]:
        missing = set().union(*cut).difference(self.cache)
        if missing:
            if len(self.cache) + len(missing) > CACHE_WORDS:
                self.cache.clear()
                missing = set().union(*cut)
            self._learn(missing)
        return [b"".join(map(self.cache.__getitem__, words)) for words in cut]

    def encode_all(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text; texts are taken in groups so that new words share one trie."""
        out: list[bytes] = []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            if any(x in text for x in self.special):
                out += self._codes(group)
                group, size = [], 0
                pieces = self.cut.split(text)
                out.append(b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._codes([self._cut(p)])[0] for p in pieces))
                continue
            group.append(self._cut(text))
            size += len(text)
            if size > GROUP_CHARS:
                out += self._codes(group)
                group, size = [], 0
        return out + self._codes(group)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.decoded.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBpe:
    """The worker's tokenizer; loaded once a Python worker."""
    return ByteBpe(path)


CODES_SCHEMA = "doc_id long, ids binary, decoded string"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _texts(column: pd.Series) -> list[str]:
    return ["" if t is None else t for t in column]


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and the text decoded from them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for batch in batches:
            ids = bpe.encode_all(_texts(batch["text"]))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids, "decoded": [bpe.decode(x) for x in ids]})

    return documents.select("doc_id", "text").mapInPandas(run, CODES_SCHEMA)


def encoding_digests(documents: DataFrame, path: str) -> DataFrame:
    """As encode_documents(), with digests in place of ids and texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = tokenizer(path)
        for batch in batches:
            ids = bpe.encode_all(_texts(batch["text"]))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids],
            })

    return documents.select("doc_id", "text").mapInPandas(run, DIGEST_SCHEMA)


class FastBpe:
    """The same ids from a compiled encoder; texts with special tokens or characters whose class
    Unicode versions disagree on go to ByteBpe."""

    def __init__(self, path: str):
        import tiktoken

        self.exact = tokenizer(path)
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.exact.id_of, special_tokens={})

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        for text in texts:
            odd = any(x in text for x in self.exact.special) or not text.isascii() and self.exact.unsettled.search(text)
            yield self.exact.encode(text) if odd else np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()


@lru_cache(maxsize=4)
def fast_tokenizer(path: str) -> FastBpe:
    return FastBpe(path)
