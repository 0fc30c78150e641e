"""WARC archives: write, read back, and an index made by external merge of sorted capture runs.

Writing is plain SQL: the payload digest, the choice between response and revisit, and the record
text; Spark's text writer puts records into files with CRLF CRLF as separator, which is how WARC
records end, so any Hadoop store and the commit protocol serve. An archive is one gzip stream of at
most ``records_per_archive`` records and about ``ARCHIVE_BYTES``; a longer record has one of its own.
Offsets count in it unpacked. Reading takes each packed archive as one binary row, unpacks it as a
stream, one record in memory at a time, by Content-Length, checks every digest and yields one
capture run per archive, sorted by (URL key, date, page_id).

The index is an external merge: runs are dealt by range over (URL key, date, page_id), so that one
URL with a third of all captures is split too; each task spills its pieces of runs to its own
scratch files and merges them with a loser tree, holding one block of each run in memory.

Defined results: a null html is an empty payload, a null url has no WARC-Target-URI and an empty
key. Records with equal payloads (of at least ``least_bytes``): the rows with the largest page_id
are responses, the others refer to it; repeated rows with that page_id are all responses. A null
page_id comes after none: such a row is a response only if all its equals have null too. Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import pickle
import re
import tempfile
from collections.abc import Iterable, Iterator
from typing import BinaryIO
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import fresh_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
#: Captures are dated from here, one second a page_id, so that archives are reproducible.
EPOCH = "2026-01-01 00:00:00"
RUN_SCHEMA = "run string, offset long, url_key string, warc_date string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
INDEX_SCHEMA = RUN_SCHEMA + ", merge_part int, merge_pos long"
BLOCK = 512
#: Unpacked size of an archive.
ARCHIVE_BYTES = 64 << 20


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 5 hex digits at a time make 4 base32 digits."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def _header_value(value: Column) -> Column:
    """Control characters, spaces and percent signs would break a header line or its reading."""
    out = F.replace(value, F.lit("%"), F.lit("%25"))
    for c in (" ", "\r", "\n", "\t", "\x0b", "\x0c", "\x00"):
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html (never null), payload_bytes, payload_digest, record_type, refers_to."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html")).select(
        "*", F.octet_length("html").cast("long").alias("payload_bytes"), payload_digest(F.col("html").cast("binary")).alias("payload_digest")
    )
    # The largest page_id of each payload; the aggregate has one row for each payload and task.
    last = rows.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("last_id"), F.count("*").alias("copies")).where("copies > 1").select("payload_digest", "payload_bytes", "last_id")
    revisit = (F.col("payload_bytes") >= least_bytes) & F.col("last_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return rows.join(last, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("last_id")).alias("refers_to"),
    )


def record_text(epoch: str = EPOCH) -> Column:
    """The WARC record without its last CRLF CRLF."""
    revisit = F.col("record_type") == "revisit"
    date = F.date_format(F.to_timestamp(F.lit(epoch)) + F.make_dt_interval(secs=F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 31))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    optional = lambda test, text: F.when(test, text).otherwise(F.lit(""))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        head("WARC-Type", F.col("record_type")),
        head("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))),
        head("WARC-Date", date),
        optional(F.col("url").isNotNull(), head("WARC-Target-URI", _header_value(F.col("url")))),
        head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        head("X-Payload-Length", F.col("payload_bytes").cast("string")),
        optional(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + CRLF),
            head("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        )),
        head("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF),
        optional(~revisit, F.col("html")),
    )


def archive_of(size: Column, row: Column, records_per_archive: int, archive_bytes: int) -> Column:
    """Name of a record's archive within its task: '<c>-<block>'.

    Class c holds records of less than 2^c bytes, of which so many go into an archive that all fit; the
    smallest class has room for ``records_per_archive``. A block is as many neighbouring rows of the
    task as its class takes records, so no archive gets more, whatever other classes stand between.
    """
    least = max(0, (archive_bytes // records_per_archive).bit_length() - 1)
    size_class = F.greatest(F.lit(least), F.length(F.bin(size)).cast("int"))
    room = F.greatest(F.lit(1), F.least(F.lit(records_per_archive), F.floor(F.lit(archive_bytes) / F.pow(F.lit(2.0), size_class)).cast("int")))
    return F.concat_ws("-", size_class.cast("string"), F.floor(row.bitwiseAND(F.lit((1 << 33) - 1)) / room).cast("string"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, records_per_archive: int = 1000, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Write one record for each page, in archives of at most so many records and, but for single longer records, bytes."""
    held = decide(pages, least_bytes).select(record_text().alias("value"), F.monotonically_increasing_id().alias("row"))
    named = held.select("value", archive_of(F.octet_length("value"), F.col("row"), records_per_archive, archive_bytes).alias("archive"))
    named.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").partitionBy("archive").text(path)
    return path


def url_key(url: str | None) -> str:
    """Sort-friendly key: reversed host labels, then path and query."""
    if not url or "://" not in url:
        return url or ""
    host, rest = re.match(r"([^/?#]*)(.*)", url.split("://", 1)[1], re.S).groups()
    return ",".join(reversed(host.lower().split("."))) + ")" + (rest or "/")


def records(archive: BinaryIO) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record of an unpacked stream, by Content-Length alone."""
    at = 0
    while first := archive.readline():
        lines, size = [first], len(first)
        while lines[-1] not in (b"\r\n", b""):
            lines.append(archive.readline())
            size += len(lines[-1])
        if not first.startswith(b"WARC/") or lines[-1] == b"":
            raise ValueError(f"no record at byte {at}")
        head = dict(line.decode().removesuffix(CRLF).split(": ", 1) for line in lines[1:-1])
        n = int(head["Content-Length"])
        block, end = archive.read(n), archive.read(4)
        if len(block) != n or end != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, head, block
        at += size + n + 4


def _page(urn: str | None) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">") if urn else "none"
    return None if value == "none" else int(value)


def _order(row: tuple) -> tuple:
    """URL key, date, page_id with nulls first; then the rest, so that ties have one order."""
    return row[2], row[3], row[4] is not None, row[4] or 0, row[0], row[1]


def _runs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
    for batch in batches:
        for path, data in zip(batch["path"], batch["content"], strict=True):
            run, rows = "/".join(path.split("/")[-2:]), []
            for at, head, block in records(gzip.open(io.BytesIO(data))):
                digest, n = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                if head["WARC-Type"] == "response" and (len(block) != n or base64.b32encode(hashlib.sha1(block).digest()).decode() != digest):
                    raise ValueError(f"payload digest differs at byte {at} of {path}")
                uri = head.get("WARC-Target-URI")
                rows.append((run, at, url_key(unquote(uri) if uri else None), head["WARC-Date"], _page(head["WARC-Record-ID"]), n, digest, head["WARC-Type"], _page(head.get("WARC-Refers-To"))))
            rows.sort(key=_order)
            out = pd.DataFrame(rows, columns=columns)
            yield out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_runs(spark, path: str) -> DataFrame:
    """The capture runs of archives, one run an archive."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInPandas(_runs, RUN_SCHEMA)


class LoserTree:
    """Tournament over k sorted iterators: a step replays one leaf-to-root path, log2(k) compares."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.losers = [-1] * max(self.k, 1)
        winners = [0] * (2 * self.k)
        for i in range(self.k):
            winners[self.k + i] = i
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None if x is None else y is None or (x, a) < (y, b)

    def __iter__(self):
        while self.k and self.heads[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            head = self.heads[w] = next(self.runs[w], None)
            self.keys[w] = None if head is None else self.key(head)
            node = (w + self.k) // 2
            while node:
                if self._before(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield from pickle.load(f)
            except EOFError:
                return


def _merge(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spill each run's piece to scratch, then merge; more runs than FAN_IN are merged in passes."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    columns = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
    with tempfile.TemporaryDirectory(prefix="warc-runs-") as scratch:
        files: list[str] = []
        current = out = None
        for batch in batches:
            rows = list(batch.astype(object).where(batch.notna(), None).itertuples(index=False, name=None))
            for i in range(0, len(rows), BLOCK):
                block: list[tuple] = []
                for row in rows[i : i + BLOCK]:
                    if row[0] != current:
                        if block:
                            pickle.dump(block, out, pickle.HIGHEST_PROTOCOL)
                            block = []
                        if out:
                            out.close()
                        current = row[0]
                        files.append(os.path.join(scratch, f"{len(files)}.run"))
                        out = open(files[-1], "wb")  # noqa: SIM115
                    block.append(row)
                if block:
                    pickle.dump(block, out, pickle.HIGHEST_PROTOCOL)
        if out:
            out.close()
        while len(files) > FAN_IN:
            group, files = files[:FAN_IN], files[FAN_IN:]
            target = os.path.join(scratch, f"m{len(os.listdir(scratch))}-{len(files)}.run")
            with open(target, "wb") as f:
                for block in _blocks(LoserTree([_spilled(p) for p in group], _order)):
                    pickle.dump(block, f, pickle.HIGHEST_PROTOCOL)
            for p in group:
                os.unlink(p)
            files.append(target)
        done = 0
        for block in _blocks(LoserTree([_spilled(p) for p in files], _order), 4096):
            frame = pd.DataFrame([(*r, part, done + i) for i, r in enumerate(block)], columns=columns)
            done += len(block)
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64", "offset": "int64", "payload_bytes": "int64"})


#: Runs open at a time in one merge.
FAN_IN = 128


def _blocks(rows: Iterable[tuple], n: int = BLOCK) -> Iterator[list[tuple]]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == n:
            yield block
            block = []
    if block:
        yield block


def merge_runs(runs: DataFrame, parts: int | None = None) -> DataFrame:
    """The global index: ordered by (url_key, warc_date, page_id) over (merge_part, merge_pos)."""
    n = parts or int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartitionByRange(n, "url_key", "warc_date", "page_id", "run", "offset")
    return dealt.sortWithinPartitions("run", "url_key", "warc_date", "page_id", "offset").mapInPandas(_merge, INDEX_SCHEMA)


def archive_and_index(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write archives, read them back and merge their runs into the global index."""
    spark = pages.sparkSession
    path = write_archives(pages, path or fresh_path(spark, "warc"), least_bytes)
    return merge_runs(read_runs(spark, path))
