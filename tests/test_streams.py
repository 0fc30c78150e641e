"""Streams against their batch forms: replays by identity, chained runs, windows."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from concordat.operators.policy import read_policy
from concordat.sources import files
from concordat.streaming import replays, runs, windows
from tests import records
from tests.records import bank, event, journal, settlement

SCHEMA = "processor string, source_record_id string, amount bigint, note string, line bigint, payload_sha256 string"
IDENTITY = ("processor", "source_record_id")


@pytest.fixture(autouse=True)
def small(spark):
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.enabled": "false", replays.PROVIDER: replays.ROCKSDB}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def by_hand(rows):
    stored, out = {}, collections.Counter()
    for p, i, amount, note, line, digest in sorted(rows, key=lambda r: (r[4], r[5])):
        kind = "DISTINCT" if (p, i) not in stored else "REPLAY" if stored[p, i] == digest else "CONFLICT"
        stored.setdefault((p, i), digest)
        out[p, i, digest, kind] += 1
    return out


def counted(df):
    out = collections.Counter()
    for r in df.collect():
        out[r.processor, r.source_record_id, r.payload_sha256, r.replay_class] += r.n_rows
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = []
    for line in range(400):
        i = "hot" if rng.random() < 0.35 else f"r{rng.randint(0, 60)}"
        version = rng.choice([0, 0, 0, 1, 2])
        made.append((rng.choice(["p", "q", None]), i, (1 << 62) + version, None if version else "n", line, f"d{version}"))
    return made


def test_first_arrivals(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for n in (1, 5):
        assert counted(replays.first_arrivals(df.repartition(n), IDENTITY, "line")) == by_hand(rows)
    kept = replays.first_arrivals(df, IDENTITY, "line").where("replay_class = 'DISTINCT'").collect()
    assert {(r.processor, r.source_record_id): r.line for r in kept} == {k: min(r[4] for r in rows if r[:2] == k) for k in {r[:2] for r in rows}}
    assert replays.first_arrivals(df.limit(0), IDENTITY, "line").isEmpty()
    with pytest.raises(ValueError, match="n_rows"):
        replays.first_arrivals(df.withColumn("n_rows", F.lit(1)), IDENTITY, "line")


def test_stream_in_micro_batches_equals_one_batch(spark, rows, tmp_path):
    place, out = tmp_path / "in", str(tmp_path / "out")
    place.mkdir()
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]

    def arrive(lo, hi):
        shuffled = random.Random(lo).sample([r for r in rows if lo <= r[4] < hi], hi - lo)
        (place / f"f{lo:05d}.json").write_text("".join(json.dumps({k: v for k, v in zip(names, r, strict=True) if v is not None}) + "\n" for r in shuffled))

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(place))
        classes = replays.classified_stream(stream, IDENTITY, "line")
        query = classes.writeStream.format("parquet").options(path=out, checkpointLocation=str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()

    arrive(0, 100)
    arrive(100, 250)
    run()
    arrive(250, 400)
    run()  # a new query: the state comes from the checkpoint
    got = spark.read.parquet(out)
    assert got.schema.names == [*names, "replay_class", "n_rows"]
    assert counted(got) == by_hand(rows)
    kept = {(r.processor, r.source_record_id): (r.amount, r.note, r.line) for r in got.where("replay_class = 'DISTINCT'").collect()}
    assert kept == {(p, i): (a, n, at) for p, i, a, n, at, _ in sorted(rows, key=lambda r: -r[4])}
    spark.conf.set(replays.PROVIDER, "other")
    with pytest.raises(RuntimeError, match="RocksDB"):
        replays.classified_stream(spark.readStream.schema(SCHEMA).json(str(place)), IDENTITY, "line")


KINDS = {"PROCESSOR_EVENTS": "events", "LEDGER_JOURNALS": "journals", "PROCESSOR_SETTLEMENTS": "settlements", "BANK_ENTRIES": "banks"}
LATE = [
    {"events": [event("r", "REFUND", 25, "c", payment="q")], "journals": [journal("jr", "REFUND", 25, payment="q", clearing="CREDIT")], "banks": [bank(reference=" set ")]},
    {"events": [event("c", payment="q"), event("c", payment="q")], "journals": [journal("jc", payment="q")], "settlements": [settlement()]},
    {"settlements": [settlement("s9", processor="q")]},  # leaves 'set' with two targets
    {"events": [event("c", amount=7, payment="q")]},  # another payload of a stored identity
    {"journals": [journal("j", settlement="set", role="BANK_CASH", clearing="CREDIT", debit=99)]},
]


def statuses(tables):
    return {(r.reconciliation_key, r.status, tuple(r.reason_codes)) for t in ("transactions", "settlements") for r in tables[t].collect()}


def test_chained_runs(spark, tmp_path):
    place, root, policy = tmp_path / "in", str(tmp_path / "chain"), read_policy(records.policy())
    for family in KINDS:
        (place / family).mkdir(parents=True)

    def arrive(number):
        for family, kind in KINDS.items():
            text = "".join(json.dumps({k: v for k, v in r.items() if v is not None}) + "\n" for r in LATE[number].get(kind, ()))
            if text:
                (place / family / f"{number}.json").write_text(text)

    def run():
        streams = {f: spark.readStream.schema(schema).json(str(place / f)) for f, (_, schema) in files.FAMILIES.items()}
        runs.follow(streams, root, policy).awaitTermination()

    chain = runs.Runs(spark, root, policy)
    for number in range(len(LATE)):
        arrive(number)
        run()
    run()  # nothing new
    assert chain.numbers() == [0, 1, 4]
    assert {n: why.split(":")[0] for n, why in chain.refusals().items()} == {2: "ADMISSION AMBIGUOUS_BANK_ALLOCATION", 3: "ADMISSION IDENTITY_CONFLICT"}
    last = chain.tables()
    assert sorted((r.grain, r.revision) for r in last["proofs"].collect()) == [("SETTLEMENT", 2), ("TRANSACTION", 2), ("TRANSACTION", 3)]
    assert {r.case_status for r in last["cases"].collect()} == {"RESOLVED_BY_LATE_DATA"}
    # A micro-batch that comes again adds nothing; all records in one micro-batch end in the same results.
    before = chain.files.names()
    whole = {f: spark.createDataFrame([r for n in (0, 1, 4) for r in LATE[n].get(kind, ())], files.FAMILIES[f][1]) for f, kind in KINDS.items()}
    chain(runs.envelopes(whole), 4)
    chain(runs.envelopes(whole), 2)
    assert chain.files.names() == before and not [n for n in before if n.startswith(".incoming")]
    once = runs.Runs(spark, str(tmp_path / "once"), policy)
    once(runs.envelopes(whole), 0)
    assert statuses(once.tables()) == statuses(last) and {s for _, s, _ in statuses(last)} == {"MATCHED"}


EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def test_windowed_streams_equal_their_tables(spark, tmp_path):
    """Data in order end in the rows of the table form; a row behind the watermark is counted, and in no window."""
    rng, place = random.Random(9), tmp_path / "events"
    place.mkdir()
    made = [(i, f"2026-01-{1 + i // 60:02d} {i % 60 // 3:02d}:{rng.randint(0, 59):02d}:00", rng.randint(0, 3), rng.choice("ab"), float(i)) for i in range(240)]
    made.sort(key=lambda r: r[1])
    names = [c.split(" ")[0] for c in EVENTS.split(", ")]
    write = lambda name, rows: (place / name).write_text("".join(json.dumps(dict(zip(names, r, strict=True))) + "\n" for r in rows))
    for part in range(3):
        write(f"{part}.json", made[part * 80 : (part + 1) * 80])
    write("8.json", [(997, "2026-02-01 00:00:00", 9, "end", 0.0)])
    write("9.json", [(998, "2026-01-01 00:00:00", 0, "a", 0.0), (999, "2026-02-01 01:00:00", 9, "end", 0.0)])
    whole = spark.createDataFrame(made, EVENTS.replace("ts timestamp", "ts string"))
    for form, n_windows in ((windows.hourly, 1), (windows.sliding, 4), (windows.sessions, 1)):
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(str(place))
        out = str(tmp_path / form.__name__)
        query = form(stream).writeStream.format("parquet").outputMode("append").options(path=out, checkpointLocation=out + "-ck").trigger(availableNow=True).start()
        query.awaitTermination()
        closed = spark.read.parquet(out)
        closed = closed.where("user_id <> 9") if "user_id" in closed.columns else closed.where("event_type <> 'end'")
        assert sorted(map(str, closed.collect())) == sorted(map(str, form(whole).collect()))
        assert windows.dropped(query) == n_windows
