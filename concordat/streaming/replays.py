"""Records of a stream classified by identity: DISTINCT, REPLAY or CONFLICT.

The first payload of an identity is stored and never replaced; the same payload again is a replay,
another one a conflict. The stream keeps one digest an identity, without a watermark: an identity
may come back after any time. Within a micro-batch rows are taken by ``at``, then digest, whatever
task or order they arrive in, so a stream whose files follow ``at`` gives what one batch gives
(``first_arrivals``), however it is cut into micro-batches and restarted.

Both forms return, for each identity, payload and class, the earliest record and n_rows, the number
of its rows. A hot identity's rows are counted, not gathered: a task holds one record for each
payload of an identity.

Defined results: an identity may hold nulls, which are equal; rows without a digest or ``at`` come first;
empty input gives no rows; columns named like the result's own (replay_class, n_rows) are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from concordat.sources.scratch import written

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DISTINCT, REPLAY, CONFLICT = "DISTINCT", "REPLAY", "CONFLICT"
OWN = ("replay_class", "n_rows")


def _result(rows: DataFrame) -> T.StructType:
    if clash := set(OWN) & set(rows.columns):
        raise ValueError(f"columns {sorted(clash)} are the result's own")
    return T.StructType([*rows.schema.fields, T.StructField("replay_class", T.StringType()), T.StructField("n_rows", T.LongType())])


def first_arrivals(rows: DataFrame, identity: tuple[str, ...], at: str, digest: str = "payload_sha256") -> DataFrame:
    """The batch form. Rows are counted by payload before they meet, so no identity gathers its rows.

    Payloads are a table of their own, so what was shuffled to count them is gone when they meet. The table
    stays, for the returned frame reads it.
    """
    result = _result(rows)
    keys = [*identity, digest]
    more = [c for c in rows.columns if c not in (*keys, at)]
    order = F.struct(F.col(at))
    record = [F.min_by(F.struct(*more), order).alias("_record")] if more else []
    per = written(rows.groupBy(*keys).agg(F.min(order).alias("_at"), F.count("*").alias("_n"), *record), "payloads")
    first = F.row_number().over(Window.partitionBy(*identity).orderBy("_at", digest)) == 1
    kind = lambda name, n: F.struct(F.lit(name).alias("c"), n.alias("k"))
    classes = F.when(F.col("_first"), F.array(kind(DISTINCT, F.lit(1).cast("long")), kind(REPLAY, F.col("_n") - 1))).otherwise(F.array(kind(CONFLICT, F.col("_n"))))
    each = per.withColumn("_first", first).withColumn("_x", F.explode(classes)).where("_x.k > 0")
    place = {at: "_at", **{c: "_record" for c in more}}
    own = [F.col(c) if c in keys else F.col(place[c])[c].alias(c) for c in result.fieldNames()[: -len(OWN)]]
    return each.select(*own, F.col("_x.c").alias("replay_class"), F.col("_x.k").alias("n_rows"))


class Replays(StatefulProcessor):
    """One stored digest an identity; see the module. Records travel as JSON text, which keeps long amounts exact."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("stored", "digest string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        seen: dict[str | None, list[Any]] = {}
        for batch in rows:
            for place, digest, record in zip(batch["at"], batch["digest"], batch["record"], strict=True):
                digest, place = (None if pd.isna(digest) else digest), (None if pd.isna(place) else place)
                own = seen.setdefault(digest, [0, None, None])
                own[0] += 1
                rank = (place is not None, place if place is not None else 0)
                if own[1] is None or rank < own[1]:
                    own[1:] = rank, record
        known = self.stored.get()
        if known is None:
            first = min(seen, key=lambda d: (seen[d][1], d is not None, d or ""))
            self.stored.update((first,))
        stored = known[0] if known is not None else first
        out = []
        for digest, (n, _, record) in seen.items():
            if digest != stored:
                out.append((record, CONFLICT, n))
                continue
            new = known is None
            out += [(record, DISTINCT, 1)] * new + [(record, REPLAY, n - new)] * (n > new)
        yield pd.DataFrame(out, columns=["record", *OWN])

    def close(self) -> None:
        pass


def classified_stream(rows: DataFrame, identity: tuple[str, ...], at: str, digest: str = "payload_sha256") -> DataFrame:
    """The stream form, for append output. ``at`` is a whole number or a text; the session must use the RocksDB state store."""
    result = _result(rows)
    if rows.sparkSession.conf.get(PROVIDER, None) != ROCKSDB:
        raise RuntimeError(f"EXECUTION_ENVIRONMENT: {PROVIDER} must be {ROCKSDB}")
    key: Column = F.to_json(F.array(*(F.col(c).cast("string") for c in identity)))
    packed = rows.select(key.alias("identity"), F.col(at).alias("at"), F.col(digest).alias("digest"), F.to_json(F.struct(*rows.columns)).alias("record"))
    classes = packed.groupBy("identity").transformWithStateInPandas(Replays(), "record string, replay_class string, n_rows long", "Append", "none")
    return classes.select(F.from_json("record", T.StructType(result.fields[:-2])).alias("r"), *OWN).select("r.*", *OWN)
