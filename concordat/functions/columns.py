"""Column functions: identities, digests, ordered reasons, exact money."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,0)"


def canonical_json(columns: Mapping[str, Column | str]) -> Column:
    """JSON object text with sorted names and no blanks; null members are left out."""
    parts = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in sorted(columns.items())]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true"})


def derived_id(prefix: str, columns: Sequence[str] | Mapping[str, Column | str]) -> Column:
    """prefix and the SHA-256 of the components' canonical JSON."""
    named = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return F.concat(F.lit(prefix), F.sha2(canonical_json(named), 256))


def business_digest(columns: Mapping[str, Column | str], transport: Sequence[str] = ("payload_sha256", "received_at", "source_batch_id")) -> Column:
    """SHA-256 of a record's canonical JSON without its transport fields."""
    return F.sha2(canonical_json({c: v for c, v in columns.items() if c not in transport}), 256)


def outer_trim(text: Column) -> Column:
    """Without Unicode blanks at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def moment(text: Column) -> Column:
    """The moment of an RFC 3339 text; null if malformed."""
    shape = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
    return F.when(text.rlike(shape), F.try_to_timestamp(text))


def canonical_timestamp(text: Column) -> Column:
    """RFC 3339 text as UTC with at most six fraction digits and no trailing zeros; null if malformed."""
    full = F.date_format(F.to_utc_timestamp(moment(text), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(full, r"\.?0+$", ""), F.lit("Z"))


def reasons(tests: Mapping[str, Column]) -> Column:
    """Array of the names whose test is true, in the mapping's order."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())))


def joined(codes: Column) -> Column:
    return F.array_join(codes, "|")


def money_sum(value: Column) -> Column:
    """Exact sum; ANSI casting back rejects what leaves 64 bits."""
    return F.sum(value.cast(MONEY)).cast("bigint")


def plain_ascii(text: Column) -> Column:
    return text.rlike(r"^[\x00-\x7F]*$")


def nfc(text: Column) -> Column:
    """Unicode NFC. ASCII passes through in the JVM; the rest needs the one Arrow function of the library."""
    from concordat.functions.normal import to_nfc

    return F.when(plain_ascii(text), text).otherwise(to_nfc(text))


def exact_amount(text: Column) -> Column:
    """Decimal of a canonical whole number of at most 38 digits; null for any other text."""
    return F.when(text.rlike("^(0|-?[1-9][0-9]{0,37})$"), text).cast(MONEY)


def canonical_base64(text: Column) -> Column:
    """Bytes of canonical base64; null for text that isn't what its bytes encode to."""
    raw = F.try_to_binary(text, F.lit("base64"))
    return F.when(F.regexp_replace(F.base64(raw), r"\s", "") == text, raw)


def counter_hash(*parts: Column) -> Column:
    """Unsigned 64-bit number from the first eight bytes of the SHA-256 of the parts, as a decimal."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def semantic_id(prefix: str, *parts: Column) -> Column:
    """prefix, a dash and 32 hex digits."""
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 32))


def seconds_after(base: str, seconds: Column) -> Column:
    """Canonical UTC text of a moment so many seconds after base."""
    at = F.timestamp_add("SECOND", seconds.cast("int"), F.lit(base).cast("timestamp"))
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def replay_class(stored: Column, observed: Column) -> Column:
    """DISTINCT without a stored digest, REPLAY with the same one, else CONFLICT."""
    return F.when(stored.isNull(), "DISTINCT").when(stored == observed, "REPLAY").otherwise("CONFLICT")
