"""Chat formatting by incremental black-box rendering.

The template is a black box ``render(messages) -> str``. Successive prefixes of a conversation are
rendered; a turn's span is what its prefix adds to the one before. A template that changes earlier
output (it rewrites history) is found because the shorter output is then no prefix of the longer;
the turn is flagged and its span begins where the two outputs part. A turn's content inside its
span is found by rendering the turn once more with an empty text.

``context`` says how many turns before it a turn's rendering may depend on. With a number, prefixes
are rendered in blocks of ``BLOCK_TURNS`` (plus that context), so a conversation of any length
costs linear time and constant memory; with None, whole conversations are rendered.

Rows are dealt by range over (conv_id, turn), so that a conversation with a third of all rows is
formatted by many tasks. A conversation that crosses tasks leaves its blocks, which a second pass
folds into one digest in order (SHA-256 is sequential), streaming and in constant memory. That
folding needs ``context`` = 0; other templates are grouped whole.

Defined results: null text and null role are empty; turns are ordered by turn (nulls first), then
role, then text, so ties and repeated rows have one order; rows with a null conv_id form one
conversation. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import materialize

Message = tuple[str, str]
BLOCK_TURNS = 32


@dataclass(frozen=True)
class InstTemplate:
    """Marks turns by control strings; control strings inside texts are escaped reversibly.

    A backslash is doubled, and a control string is broken after its first character by ``\\|``.
    """

    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    context: int | None = 0

    def escape(self, text: str) -> str:
        found = "|".join(map(re.escape, self.controls))
        return re.sub(found, lambda m: m[0][0] + "\\|" + m[0][1:], text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\\" if m[1] == "\\" else "", text, flags=re.S)

    def render(self, messages: Sequence[Message]) -> str:
        return "".join(f"<s>[INST] {self.escape(role)} [/INST] {self.escape(text)} </s>\n" for role, text in messages)

    def parse(self, output: str) -> list[Message]:
        """The messages of an output; raises if it is not one."""
        turns = re.findall(r"<s>\[INST\] (.*?) \[/INST\] (.*?) </s>\n", output, re.S)
        messages = [(self.unescape(role), self.unescape(text)) for role, text in turns]
        if self.render(messages) != output:
            raise ValueError("this is not an output of the template")
        return messages


@dataclass
class Turn:
    role: str
    start: int
    end: int
    content: tuple[int, int]
    rewrites: bool


@dataclass
class Rendered:
    text: str = ""
    turns: list[Turn] = field(default_factory=list)


def _shared(a: str, b: str) -> int:
    """Length of the common prefix, by bisection."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def _content(added: str, empty: str, wanted: str) -> tuple[int, int]:
    """Where the turn's own text stands in what the turn added; empty: the same turn without text."""
    n = len(added) - len(empty)
    for s in range(_shared(added, empty), -1, -1):
        if added[s : s + n] == wanted and added[:s] == empty[:s] and added[s + n :] == empty[s:]:
            return s, s + n
    at = added.find(wanted)
    return (at, at + len(wanted)) if at >= 0 else (0, len(added))


def render_incrementally(messages: Sequence[Message], render: Callable[[Sequence[Message]], str], escape: Callable[[str], str] = str, before: Sequence[Message] = ()) -> Rendered:
    """Spans of ``messages`` after the context turns ``before``; offsets count from the block's start."""
    shown = list(before)
    last = first = render(shown) if shown else ""
    out = Rendered()
    for role, text in messages:
        now, empty = render([*shown, (role, text)]), render([*shown, (role, "")])
        rewrites = not now.startswith(last)
        start = _shared(last, now) if rewrites else len(last)
        at, end = _content(now[start:], empty[start:], escape(text))
        out.turns.append(Turn(role, start - len(first), len(now) - len(first), (start + at - len(first), start + end - len(first)), rewrites))
        shown.append((role, text))
        last = now
    out.text = last[len(first) :]
    return out


def rewrites_history(template, probe: Sequence[Message]) -> bool:
    return any(t.rewrites for t in render_incrementally(probe, template.render, getattr(template, "escape", str)).turns)


BLOCK_SCHEMA = "conv_id long, part int, seq long, whole boolean, n_turns long, turns binary, loss binary, loss_chars long, formatted_chars long, formatted string, spans array<struct<role:string,start:long,end:long,loss_start:long,loss_end:long>>, rewrites boolean"


def _read_back(block: Rendered, template, trained: frozenset[str]) -> tuple[int, bytes, bytes, int]:
    """What a reader of the output finds: turns, and the unescaped text under the loss mask."""
    turns = template.parse(block.text)
    loss = [template.unescape(block.text[t.content[0] : t.content[1]]) for t in block.turns if t.role in trained]
    joined = "".join(loss)
    return len(turns), "".join(f"{r}\n{t}\n" for r, t in turns).encode(), joined.encode(), len(joined)


def _format(template, trained: frozenset[str], keep_text: bool):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def blocks(conv, seq: int, messages: list[Message], before: list[Message], base: int) -> tuple:
            r = render_incrementally(messages, template.render, template.escape, before)
            n, turns, loss, chars = _read_back(r, template, trained)
            spans = [dict(role=t.role, start=base + t.start, end=base + t.end, loss_start=base + t.content[0] if t.role in trained else None, loss_end=base + t.content[1] if t.role in trained else None) for t in r.turns] if keep_text else None
            return (conv, part, seq, False, n, turns, loss, chars, len(r.text), r.text if keep_text else None, spans, any(t.rewrites for t in r.turns))

        size = BLOCK_TURNS if template.context is not None else None
        out: list[tuple] = []
        conv, seq, base, messages, before, started = None, 0, 0, [], [], False

        def close() -> None:
            nonlocal messages, before, base, seq
            if messages:
                out.append(blocks(conv, seq, messages, before, base))
                before = (before + messages)[-template.context :] if template.context else []
                base += out[-1][8]
                seq += 1
                messages = []

        for batch in batches:
            ids = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None)
            for c, role, text in zip(ids, batch["role"], batch["text"], strict=True):
                if not started or c != conv:
                    close()
                    conv, seq, base, before, started = c, 0, 0, [], True
                messages.append((role or "", text or ""))
                if size and len(messages) == size:
                    close()
            if len(out) >= 256:
                yield _frame(out)
                out.clear()
        close()
        if out:
            yield _frame(out)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])
    return frame.astype({"conv_id": "Int64"})


def format_blocks(conversations: DataFrame, template=None, trained: Iterable[str] = ("assistant",), keep_text: bool = True, parts: int | None = None) -> DataFrame:
    """Formatted blocks of turns with their spans: the operator's real output.

    conv_id, part, seq (order of a conversation's blocks), n_turns, formatted, spans (offsets
    within the task's piece of the conversation), rewrites, and the digests' input.
    """
    template = template or InstTemplate()
    rows = conversations.select("conv_id", "turn", "role", "text")
    n = parts or int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "conv_id", "turn", "role", "text") if template.context == 0 else rows.repartition(n, "conv_id")
    ordered = dealt.sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")))
    return ordered.select("conv_id", "role", "text").mapInPandas(_format(template, frozenset(trained), keep_text), BLOCK_SCHEMA)


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"


def _fold(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a conversation from its ordered blocks, whatever their number."""
    columns = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
    state = None

    def row() -> tuple:
        conv, n, turns, chars, loss, formatted, rewrites = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, rewrites

    for batch in batches:
        out = []
        ids = batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None)
        for c, n, turns, loss, chars, formatted, rewrites in zip(ids, batch["n_turns"], batch["turns"], batch["loss"], batch["loss_chars"], batch["formatted_chars"], batch["rewrites"], strict=True):
            if state is None or state[0] != c:
                if state:
                    out.append(row())
                state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
            state[1] += n
            state[2].update(turns)
            state[3] += chars
            state[4].update(loss)
            state[5] += formatted
            state[6] |= bool(rewrites)
        if out:
            yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})
    if state:
        yield pd.DataFrame([row()], columns=columns).astype({"conv_id": "Int64"})


def digests(blocks: DataFrame) -> DataFrame:
    """One row of digests for each conversation of format_blocks()."""
    dealt = blocks.select("conv_id", "part", "seq", "n_turns", "turns", "loss", "loss_chars", "formatted_chars", "rewrites").repartition("conv_id")
    return dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "seq").mapInPandas(_fold, DIGEST_SCHEMA)


def format_conversations(conversations: DataFrame, template=None, trained: Iterable[str] = ("assistant",)) -> DataFrame:
    """Digests of every formatted conversation; blocks are written once to the shared folder."""
    blocks = materialize(format_blocks(conversations, template, trained, keep_text=False), "chat")
    return digests(blocks)
