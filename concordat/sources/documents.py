"""Control documents (manifest, policy, correction): one object each, small, strict JSON, with its byte identity."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from concordat.sources.files import SCHEMA, strict_fault

# Fixed value: the bytes a control document may have.
MOST_BYTES = 131_072
MOST_DEPTH = 32


@dataclass(frozen=True)
class Document:
    """What a document says, and the size and SHA-256 of the bytes it was read from."""

    content: dict[str, Any]
    size_bytes: int
    sha256: str


def single(rows: DataFrame, what: str) -> Row:
    """The only row of rows. Two are asked for at most, so none and several are told apart without a count."""
    first = rows.take(2)
    if len(first) != 1:
        raise ValueError(f"{SCHEMA}: {what} is {'several rows' if first else 'no row'}, not one")
    return first[0]


def depth(value: Any, most: int = MOST_DEPTH) -> int:
    """Nested objects and lists, a level at a time; stops one beyond most."""
    level, found = [value], 0
    while level and found <= most:
        level = [x for v in level if isinstance(v, dict | list) for x in (v.values() if isinstance(v, dict) else v)] if (nested := any(isinstance(v, dict | list) for v in level)) else []
        found += nested
    return found


def read_document(spark: SparkSession, path: str, most_bytes: int = MOST_BYTES) -> Document:
    """The document at path, on any of Spark's file systems; anything but one small strict JSON object is refused.
    An empty object gives no row to Spark and is refused as such.

    The size is tested before the content is read, so a large object never reaches the driver.
    """
    try:
        raw = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        raise ValueError(f"{SCHEMA}: {path} can't be read") from error
    size = single(raw.select("length"), path).length
    if size > most_bytes:
        raise ValueError(f"{SCHEMA}: {path} has {size} bytes; the bound is {most_bytes}")
    content = bytes(single(raw.where(raw.length <= most_bytes).select("content"), path).content)
    try:
        text = content.decode("utf-8")
    except UnicodeDecodeError as error:
        raise ValueError(f"{SCHEMA}: {path} is not UTF-8") from error
    fault = strict_fault(text)
    if fault is None and depth(found := json.loads(text)) > MOST_DEPTH:
        fault = "TOO_DEEP"
    if fault:
        raise ValueError(f"{SCHEMA}: {path} is no strict JSON object: {fault}")
    return Document(found, len(content), hashlib.sha256(content).hexdigest())
