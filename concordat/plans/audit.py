"""Queries that audit tables and histories, with their independent SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordat.operators import admission, compare, digests, history, results
from concordat.operators import settlements as stl
from concordat.operators import transactions as txn
from concordat.plans import registry
from concordat.plans.oracle import FIRST, FULL, HISTORY, STL, THREE, query
from concordat.plans.registry import Query
from concordat.sources import derived, lines
from concordat.sources.scratch import deleted, freed, shared_folder, written
from concordat.sources.tables import table
from concordat.streaming import replays, windows

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DEPTH = 3
RESULT = ("reconciliation_key", "status", "difference_minor")


def with_sql(sql: str):
    """Register a query together with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


_SEEN = """seen AS (SELECT *, MIN(line) OVER (PARTITION BY processor, source_record_id, payload_sha256) AS first_line, FIRST_VALUE(payload_sha256) OVER w AS stored, ROW_NUMBER() OVER w AS rn
  FROM v_raw_event WINDOW w AS (PARTITION BY processor, source_record_id ORDER BY line, payload_sha256))"""


@with_sql(query("""SELECT processor, source_record_id, payload_sha256, CASE WHEN payload_sha256 <> stored THEN 'CONFLICT' WHEN rn = 1 THEN 'DISTINCT' ELSE 'REPLAY' END AS replay_class, COUNT(*) AS n_rows, MIN(first_line) AS line
  FROM seen GROUP BY 1, 2, 3, 4""", _SEEN))
def replay_classes(s, d):
    """Records by class against the first payload of their identity, in the order of lines."""
    rows = derived.raw(s, d, "event").select(*registry.IDENTITY, "payload_sha256", "line")
    found = replays.first_arrivals(rows, registry.IDENTITY, "line")
    return found.select(*registry.IDENTITY, "payload_sha256", "replay_class", "n_rows", "line")


def _audited(s, d) -> tuple[DataFrame, DataFrame]:
    """Transaction results, a table written once, and the same with planted differences: changed, missing and extra rows."""
    at = derived.stored(s, d, "v_movement")
    rows = written(registry._reconciled(s, at).select(*RESULT, F.expr("CAST(substring(payment_id, 5) AS BIGINT)").alias("k")), "results")
    deleted(*at.views.values())
    actual = rows.where("k % 997 <> 3").withColumn("difference_minor", F.col("difference_minor") + F.when(F.col("k") % 499 == 1, 1).otherwise(0))
    actual = actual.withColumn("reconciliation_key", F.when(F.col("k") % 1009 == 5, F.concat("reconciliation_key", F.lit("x"))).otherwise(F.col("reconciliation_key")))
    return rows.select(*RESULT), actual.select(*RESULT)


_EXPECTED = f"""expected AS MATERIALIZED (SELECT {", ".join(RESULT)}, CAST(substr(payment_id, 5) AS BIGINT) AS k FROM recon),
actual AS MATERIALIZED (SELECT CASE WHEN k % 1009 = 5 THEN reconciliation_key || 'x' ELSE reconciliation_key END AS reconciliation_key, status, difference_minor + CASE WHEN k % 499 = 1 THEN 1 ELSE 0 END AS difference_minor FROM expected WHERE k % 997 <> 3)"""


def _tree_sql(name: str) -> str:
    """CTEs <name>_0 to <name>_<DEPTH>: the nodes of each level."""
    rows = f"""{name}_row AS (SELECT sha256('{{"reconciliation_key":"' || reconciliation_key || '"}}') AS place,
      sha256('{{"difference_minor":' || difference_minor || ',"reconciliation_key":"' || reconciliation_key || '","status":"' || status || '"}}') AS r FROM {name}),
    {name}_{DEPTH} AS MATERIALIZED (SELECT substr(place, 1, {DEPTH}) AS node, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_places,
      sha256(string_agg(place || ' ' || low || ' ' || high || ' ' || n || chr(10), '' ORDER BY place)) AS digest
      FROM (SELECT place, MIN(r) AS low, MAX(r) AS high, COUNT(*) AS n FROM {name}_row GROUP BY ALL) GROUP BY 1)"""
    for level in range(DEPTH - 1, -1, -1):
        rows += f""", {name}_{level} AS MATERIALIZED (SELECT substr(node, 1, {level}) AS node, CAST(SUM(n_rows) AS BIGINT) AS n_rows, CAST(SUM(n_places) AS BIGINT) AS n_places, sha256(string_agg(node || ' ' || digest || chr(10), '' ORDER BY node)) AS digest FROM {name}_{level + 1} GROUP BY 1)"""
    return rows


def _levels(select: str) -> str:
    return " UNION ALL ".join(select.replace("#", str(level)) for level in range(DEPTH + 1))


@with_sql(query(_levels("SELECT # AS level, node, n_rows, n_places, digest FROM expected_#"), FULL, _EXPECTED, _tree_sql("expected")))
def digest_tree(s, d):
    """All nodes of the digest tree over transaction results; level 0 is the table's ordered digest."""
    return digests.written_tree(digests.placed(_audited(s, d)[0], RESULT[:1]), DEPTH)


@with_sql(query("SELECT COALESCE(e.reconciliation_key, a.reconciliation_key) AS reconciliation_key, CASE WHEN a.status IS NULL THEN 'missing' WHEN e.status IS NULL THEN 'extra' ELSE 'changed' END AS side FROM expected e FULL JOIN actual a ON e.reconciliation_key = a.reconciliation_key WHERE e.status IS NULL OR a.status IS NULL OR e.status <> a.status OR e.difference_minor <> a.difference_minor", FULL, _EXPECTED))
def located_differences(s, d):
    return digests.located(*_audited(s, d), RESULT[:1], DEPTH)


@with_sql(query(_levels("SELECT # AS level, COUNT(*) AS n_nodes, COUNT(*) FILTER (e.digest IS DISTINCT FROM a.digest) AS n_unequal FROM expected_# e FULL JOIN actual_# a ON e.node = a.node"), FULL, _EXPECTED, _tree_sql("expected"), _tree_sql("actual")))
def difference_descent(s, d):
    """How many nodes of each level differ: what a comparison of published tables reads."""
    trees = [digests.written_tree(digests.placed(rows, RESULT[:1]), DEPTH) for rows in _audited(s, d)]
    return digests.descent(*trees, digests.unequal(*trees, DEPTH))


# Revisions of a customer's orders: each follows the one before; some priors are of no order, and some first ones follow the last.
_LINKS = """links AS MATERIALIZED (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 211 = 0 THEN -o_orderkey WHEN before IS NULL AND o_custkey % 97 = 0 THEN last ELSE before END AS prior FROM (
  SELECT o_orderkey, o_custkey, LAG(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before, MAX(o_orderkey) OVER (PARTITION BY o_custkey) AS last FROM orders))"""


@with_sql(f"""WITH RECURSIVE {_LINKS}, walk AS (SELECT id, id AS root, 1 AS depth, CASE WHEN prior IS NOT NULL THEN 'ORPHAN' END AS fault FROM links WHERE prior IS NULL OR prior NOT IN (SELECT id FROM links)
  UNION ALL SELECT l.id, w.root, w.depth + 1, NULL FROM walk w JOIN links l ON l.prior = w.id)
SELECT l.id, w.root, w.depth, CASE WHEN w.id IS NULL THEN 'CYCLE' ELSE w.fault END AS fault FROM links l LEFT JOIN walk w USING (id)""")
def revision_ancestry(s, d):
    """Root and depth of every revision, with orphans and cycles."""
    own = Window.partitionBy("o_custkey")
    before, last = F.lag("o_orderkey").over(own.orderBy("o_orderkey")), F.max("o_orderkey").over(own)
    orders = table(s, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", before.alias("before"), last.alias("last"))
    prior = F.when(F.col("id") % 211 == 0, -F.col("id")).when(F.col("before").isNull() & (F.col("o_custkey") % 97 == 0), F.col("last")).otherwise(F.col("before"))
    return history.ancestry(orders.select("id", prior.alias("prior")))


_MARK = "substr(reconciliation_key, 5, 2)"


def _chained(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Proofs, results and cases of two runs, with planted faults of every kind."""
    true = registry._history(s, d).withColumn("grain", F.lit("transaction")).withColumn("policy_sha256", F.lit("policy"))
    order = Window.partitionBy(*txn.KEYS, "reconciliation_key").orderBy("run")
    true = true.withColumn("prior_proof_id", F.lag("proof_id").over(order))
    mark, second = F.expr(_MARK), F.col("run") == 2
    proofs = true.withColumn("status", F.when(second & (mark == "00"), "WITHIN_TOLERANCE").otherwise(F.col("status")))
    proofs = proofs.withColumn("prior_proof_id", F.when(second & (mark == "01"), "prf:0").otherwise(F.col("prior_proof_id"))).where(~(second & (mark == "02")))
    proofs = proofs.withColumn("proof_id", F.when(~second & (mark == "03"), "prf:1").otherwise(F.col("proof_id")))
    cases = history.derived_cases(true, within=txn.KEYS)
    cases = cases.withColumn("case_status", F.when(mark == "04", "CLOSED").otherwise(F.col("case_status")))
    return proofs, true, cases


_CHAIN = f"""base AS MATERIALIZED (SELECT *, {_MARK} AS mark, LAG(proof_id) OVER (PARTITION BY reconciliation_key ORDER BY run) AS prior FROM (SELECT h.*, r.difference_minor FROM history h
    JOIN (SELECT 1 AS run, reconciliation_key, difference_minor FROM first_run UNION ALL SELECT 2, reconciliation_key, difference_minor FROM recon) r USING (run, reconciliation_key))),
proof AS MATERIALIZED (SELECT run, reconciliation_key, revision, CASE WHEN run = 2 AND mark = '00' THEN 'WITHIN_TOLERANCE' ELSE status END AS status, reason_codes, difference_minor, proof_id AS derived_id,
    CASE WHEN run = 1 AND mark = '03' THEN 'prf:1' ELSE proof_id END AS proof_id, CASE WHEN run = 2 AND mark = '01' THEN 'prf:0' ELSE prior END AS prior FROM base WHERE NOT (run = 2 AND mark = '02')),
stored_case AS (SELECT run, reconciliation_key, initial, n, CASE WHEN {_MARK} = '04' THEN 'CLOSED' WHEN status = 'EXCEPTION' THEN 'OPEN' ELSE 'RESOLVED_BY_LATE_DATA' END AS case_status, had FROM (
    SELECT *, COUNT(*) OVER (PARTITION BY reconciliation_key ORDER BY run) AS n FROM (SELECT b.run, b.reconciliation_key, b.status, MIN_BY(e.proof_id, e.run) AS initial, MAX_BY(e.reason_codes, e.run) AS had
    FROM base b JOIN base e ON e.reconciliation_key = b.reconciliation_key AND e.run <= b.run AND e.status = 'EXCEPTION' GROUP BY b.run, b.reconciliation_key, b.status))),
own_case AS (SELECT run, reconciliation_key, initial, COUNT(*) OVER (PARTITION BY reconciliation_key ORDER BY run) AS n, CASE WHEN status = 'EXCEPTION' THEN 'OPEN' ELSE 'RESOLVED_BY_LATE_DATA' END AS case_status, had FROM (
    SELECT b.run, b.reconciliation_key, b.status, MIN_BY(e.proof_id, e.run) AS initial, MAX_BY(e.reason_codes, e.run) AS had
    FROM proof b JOIN proof e ON e.reconciliation_key = b.reconciliation_key AND e.run <= b.run AND e.status = 'EXCEPTION' GROUP BY b.run, b.reconciliation_key, b.status))"""


@with_sql(query("""SELECT run, reconciliation_key, 'PROOF_ID' AS fault FROM proof WHERE proof_id <> derived_id
UNION ALL SELECT p.run, p.reconciliation_key, 'BROKEN_CHAIN' FROM proof p LEFT JOIN proof b ON b.reconciliation_key = p.reconciliation_key AND b.run = p.run - 1 WHERE p.prior IS DISTINCT FROM b.proof_id
UNION ALL SELECT 2, reconciliation_key, 'VANISHED' FROM proof a WHERE run = 1 AND NOT EXISTS (SELECT 1 FROM proof b WHERE b.reconciliation_key = a.reconciliation_key AND b.run = 2)
UNION ALL SELECT r.run, r.reconciliation_key, 'RESULT' FROM base r LEFT JOIN proof p ON p.run = r.run AND p.reconciliation_key = r.reconciliation_key WHERE p.status IS DISTINCT FROM r.status
UNION ALL SELECT COALESCE(x.run, y.run), COALESCE(x.reconciliation_key, y.reconciliation_key), 'CASE' FROM own_case x FULL JOIN stored_case y ON x.run = y.run AND x.reconciliation_key = y.reconciliation_key
  WHERE x.run IS NULL OR y.run IS NULL OR x.initial <> y.initial OR x.n <> y.n OR x.case_status <> y.case_status OR x.had <> y.had""", FULL, FIRST, HISTORY, _CHAIN))
def chain_audit(s, d):
    """Every fault of a two-run history of proofs, results and cases."""
    return history.chain_faults(*_chained(s, d), runs=2, within=txn.KEYS)


@with_sql(query("""SELECT processor, source_record_id, payload_sha256, ROW_NUMBER() OVER (ORDER BY line, processor, source_record_id, payload_sha256) AS position,
  ROW_NUMBER() OVER w AS occurrence, ROW_NUMBER() OVER w > 1 AS replayed FROM v_raw_event WINDOW w AS (PARTITION BY processor, source_record_id ORDER BY line, payload_sha256)"""))
def occurrence_inventory(s, d):
    """Events as lines of compressed text files: each record's place over all files, and its occurrence by file and line."""
    order = ("line", *registry.IDENTITY, "payload_sha256")
    place = f"{shared_folder(s)}/events-{uuid.uuid4().hex}"
    texts = derived.raw(s, d, "event").select(*order).orderBy(*order).select(F.to_json(F.struct(*registry.IDENTITY, "payload_sha256")).alias("value"))
    with freed(s):
        texts.write.text(place, compression="gzip")
    record = F.from_json("value", "processor string, source_record_id string, payload_sha256 string")
    rows = lines.numbered(s, [place], r=record).select("position", "r.*")
    deleted(s.read.text(place))
    found = lines.occurrences(rows, registry.IDENTITY)
    return found.select(*registry.IDENTITY, "payload_sha256", "position", F.col("occurrence").cast("bigint").alias("occurrence"), "replayed")


@with_sql("SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, COUNT(*) AS n_events, MAX(value) AS most FROM (SELECT event_type, value, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE * n AS w FROM events, (SELECT unnest(range(0, 4)) AS n) s WHERE ts IS NOT NULL) GROUP BY ALL")
def event_sliding_windows(s, d):
    return windows.sliding(table(s, d, "events"))


@with_sql("""WITH e AS (SELECT user_id, ts, CASE WHEN ts < LAG(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT user_id, ts, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e)
SELECT user_id, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(MAX(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end, COUNT(*) AS n_events FROM n GROUP BY user_id, session""")
def event_sessions(s, d):
    return windows.sessions(table(s, d, "events"))


@with_sql(query("""SELECT merchant_id, currency, settlement_id, COUNT(*) AS n_targets, COUNT(*) FILTER (processor = 'p-1') AS n_in_bundle FROM (SELECT DISTINCT * FROM v_raw_target) GROUP BY ALL HAVING COUNT(*) > 1"""))
def merged_targets(s, d):
    """References that are ambiguous only in the state that a second run leaves: the first run held one processor's settlements, the second the other's."""
    keys = derived.raw(s, d, "target").select(*stl.KEYS)
    stored, observed = keys.where("processor = 'p-0'"), keys.where("processor <> 'p-0'")
    alone = observed.distinct().groupBy(*stl.REFERENCE).agg(F.count("*").alias("n_in_bundle"))
    return stl.ambiguous(stored.unionByName(observed)).join(alone, list(stl.REFERENCE), "left").withColumn("n_in_bundle", F.coalesce("n_in_bundle", F.lit(0).cast("bigint")))


_STL_CODES = "CASE WHEN reason_codes = '' THEN [] ELSE string_split(reason_codes, '|') END"
_STL_KNOWN = "[" + ", ".join(f"'{r}'" for r in (*stl.REASONS, "TOLERATED_DIFFERENCE")) + "]"
_FAULTY = """faulty AS (SELECT reconciliation_key, processor, CASE WHEN m % 59 = 0 THEN merchant_id || 'x' ELSE merchant_id END AS merchant_id, settlement_id, settlement_cycle, CASE WHEN m % 53 = 0 THEN lower(currency) ELSE currency END AS currency,
  processor_net_minor, ledger_clearing_minor, bank_minor, processor_ledger_delta_minor, processor_bank_delta_minor, ledger_bank_delta_minor + CASE WHEN m % 37 = 0 THEN 1 ELSE 0 END AS ledger_bank_delta_minor,
  difference_minor - CASE WHEN m % 31 = 0 THEN 1 ELSE 0 END AS difference_minor, processor_settlement_count, ledger_journal_count, allocated_bank_entry_count - CASE WHEN m % 41 = 0 THEN 99 ELSE 0 END AS allocated_bank_entry_count,
  CASE WHEN m % 43 = 0 THEN 'MATCHED' WHEN m % 61 = 0 THEN 'UNKNOWN' ELSE status END AS status, CASE WHEN m % 47 = 0 THEN 'NO_SUCH_REASON' ELSE reason_codes END AS reason_codes
  FROM (SELECT *, ABS(processor_net_minor) + length(settlement_id) AS m FROM three))"""


@with_sql(query(f"""SELECT reconciliation_key, faults FROM (SELECT reconciliation_key, concat_ws('|', CASE WHEN NOT regexp_full_match(currency, '[A-Z]{{3}}') THEN 'CURRENCY' END,
  CASE WHEN len(list_distinct({_STL_CODES})) <> len({_STL_CODES}) OR NOT list_has_all({_STL_KNOWN}, {_STL_CODES}) THEN 'REASONS' END, CASE WHEN status NOT IN ('MATCHED', 'WITHIN_TOLERANCE', 'EXCEPTION') THEN 'STATUS' END,
  CASE WHEN processor_ledger_delta_minor <> processor_net_minor - ledger_clearing_minor OR processor_bank_delta_minor <> processor_net_minor - bank_minor OR ledger_bank_delta_minor <> ledger_clearing_minor - bank_minor THEN 'DELTA' END,
  CASE WHEN difference_minor <> GREATEST(ABS(processor_ledger_delta_minor), ABS(processor_bank_delta_minor), ABS(ledger_bank_delta_minor)) THEN 'DIFFERENCE' END,
  CASE WHEN processor_settlement_count < 0 OR ledger_journal_count < 0 OR allocated_bank_entry_count < 0 THEN 'COUNT' END,
  CASE WHEN (status = 'MATCHED') <> (difference_minor = 0 AND reason_codes = '') OR (status = 'WITHIN_TOLERANCE') <> (difference_minor > 0 AND reason_codes = 'TOLERATED_DIFFERENCE') THEN 'STATUS_REASON' END,
  CASE WHEN reconciliation_key <> {STL} THEN 'KEY' END) AS faults FROM faulty) WHERE faults <> ''""", THREE, _FAULTY))
def settlement_semantic_check(s, d):
    """Contradictions of planted settlement results."""
    rows, m = registry._three(s, d), F.abs("processor_net_minor") + F.length("settlement_id")
    changed = {
        "merchant_id": F.when(m % 59 == 0, F.concat("merchant_id", F.lit("x"))).otherwise(F.col("merchant_id")), "currency": F.when(m % 53 == 0, F.lower("currency")).otherwise(F.col("currency")),
        "ledger_bank_delta_minor": F.col("ledger_bank_delta_minor") + F.when(m % 37 == 0, 1).otherwise(0), "difference_minor": F.col("difference_minor") - F.when(m % 31 == 0, 1).otherwise(0),
        "allocated_bank_entry_count": F.col("allocated_bank_entry_count") - F.when(m % 41 == 0, 99).otherwise(0),
        "status": F.when(m % 43 == 0, "MATCHED").when(m % 61 == 0, "UNKNOWN").otherwise(F.col("status")), "reason_codes": F.when(m % 47 == 0, "NO_SUCH_REASON").otherwise(F.col("reason_codes")),
    }
    return results.row_faults(rows.select(*(changed.get(c, F.col(c)).alias(c) for c in rows.columns)), "settlements")


_LARGE = 9 * 10**8


@with_sql(query(f"SELECT 'ARITHMETIC_OVERFLOW' AS rule, 'PROCESSOR_EVENTS' AS family, processor || '/' || merchant_id || '/' || currency AS identity, CAST(SUM(CAST(amount_minor AS HUGEINT) * {_LARGE}) AS VARCHAR) AS detail FROM v_event GROUP BY processor, merchant_id, currency HAVING SUM(CAST(amount_minor AS HUGEINT) * {_LARGE}) > 9223372036854775807"))
def overflowing_sums(s, d):
    """Merchants whose amounts, all of them large, add up to more than 64 bits."""
    large = derived.events(s, d).withColumn("amount_minor", (F.col("amount_minor").cast("decimal(38,0)") * _LARGE).cast("decimal(38,0)"))
    return admission.overflows(large, "PROCESSOR_EVENTS", ("processor", "merchant_id", "currency"))


_PAIR = "processor, source_record_id, event_type, amount_minor, currency"


@with_sql(query(f"""SELECT {_PAIR}, CAST(ABS(SUM(e)) AS BIGINT) AS n_rows, CASE WHEN SUM(e) > 0 THEN 'expected' ELSE 'actual' END AS side
  FROM (SELECT {_PAIR}, 1 AS e FROM v_raw_event UNION ALL SELECT {_PAIR}, -1 FROM v_event) GROUP BY {_PAIR} HAVING SUM(e) <> 0"""))
def raw_against_canonical(s, d):
    """Raw records that the canonical ones don't hold as often, and the other way round."""
    names = [c.strip() for c in _PAIR.split(",")]
    found = compare.differences(derived.raw(s, d, "event").select(*names), derived.events(s, d).select(*names))
    return found.select(*names, F.abs("balance").alias("n_rows"), "side")


_PAYMENT, _SETTLING = "('CAPTURE','REFUND','CHARGEBACK','REVERSAL')", "('SETTLEMENT','FEE','RESERVE')"


def _record_sql(view: str, family: str, identity: str, json: str, texts: str, numbers: str, moment: str, optional: str, **tests: str) -> str:
    """Every broken rule of every record of a view in one scan; tests are a family's own rules, named by number."""
    shown, filled = texts.split(), [c for c in f"{texts} {numbers} received_at".split() if c not in optional.split()]
    rules = {f"SCHEMA_VIOLATION:{c} is null": f"{c} IS NULL" for c in filled}
    rules |= {f"SCHEMA_VIOLATION:{c} is empty or has outer blanks": f"{c} = '' OR {c} <> trim({c})" for c in shown if c != "settlement_reference"}
    rules |= {"SCHEMA_VIOLATION:schema version": "schema_version <> '2.0'", "SCHEMA_VIOLATION:unsupported currency": "currency NOT IN ('INR','JPY','USD')"}
    stamp = f"{moment} NOT LIKE '____-__-__T__:__:__Z' OR TRY_CAST(replace(left({moment}, 19), 'T', ' ') AS TIMESTAMP) IS NULL"
    rules |= {f"SCHEMA_VIOLATION:{moment} is no moment": stamp, "SOURCE_IDENTITY_MISMATCH:payload digest": f"payload_sha256 <> sha256('{{' || {json.replace('{{', '{').replace('}}', '}').replace('AS STRING', 'AS VARCHAR')} || '}}')"}
    rules |= {name: test for name, test in (t.split(" IF ") for t in tests.values())}
    broken = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules.items())
    return query(f"SELECT split_part(b, ':', 1) AS rule, '{family}' AS family, {identity} AS identity, split_part(b, ':', 2) AS detail FROM (SELECT *, unnest([{broken}]) AS b FROM {view}) WHERE b IS NOT NULL")


@with_sql(_record_sql("v_raw_settlement", "PROCESSOR_SETTLEMENTS", "processor || '/' || source_record_id", derived.SETTLEMENT_JSON,
    "schema_version source_batch_id source_record_id processor merchant_id settlement_id settlement_cycle currency occurred_at", "gross_minor fee_minor refund_minor chargeback_minor reserve_minor reported_net_minor", "occurred_at", "",
    **{c: f"SCHEMA_VIOLATION:{c} is negative IF {c} < 0" for c in ("gross_minor", "fee_minor", "refund_minor", "chargeback_minor", "reserve_minor")}))
def admission_settlements(s, d):
    """Every broken rule of every planted settlement record."""
    return admission.row_violations(derived.raw(s, d, "settlement").drop("mark"), "PROCESSOR_SETTLEMENTS", registry.DEFAULT)


@with_sql(_record_sql("v_raw_bank", "BANK_ENTRIES", "concat_ws('/', bank_account_id, bank_record_id)", derived.BANK_JSON,
    "schema_version source_batch_id bank_record_id bank_account_id merchant_id settlement_reference direction currency value_at", "amount_minor", "value_at", "settlement_reference",
    side="SCHEMA_VIOLATION:unknown direction IF direction NOT IN ('CREDIT', 'DEBIT')", amount="SCHEMA_VIOLATION:amount_minor is not positive IF amount_minor <= 0"))
def admission_bank(s, d):
    """Every broken rule of every planted bank entry."""
    return admission.row_violations(derived.raw(s, d, "bank").drop("mark"), "BANK_ENTRIES", registry.DEFAULT)


_DEBITS = "CASE WHEN side_1 = 'DEBIT' THEN amount_1 ELSE 0 END + CASE WHEN line_2 IS NOT NULL AND side_2 = 'DEBIT' THEN amount_2 ELSE 0 END"


@with_sql(_record_sql("v_raw_ledger", "LEDGER_JOURNALS", "ledger_system || '/' || journal_id", derived.LEDGER_JSON,
    "schema_version ledger_system journal_id source_batch_id processor merchant_id payment_id settlement_id settlement_cycle entry_type currency effective_at", "", "effective_at", "payment_id settlement_id settlement_cycle",
    kind=f"SCHEMA_VIOLATION:unknown entry_type IF entry_type NOT IN {_PAYMENT} AND entry_type NOT IN {_SETTLING}",
    key=f"UNBALANCED_JOURNAL:business key IF CASE WHEN entry_type IN {_PAYMENT} THEN payment_id IS NULL OR settlement_id IS NOT NULL OR settlement_cycle IS NOT NULL ELSE payment_id IS NOT NULL OR settlement_id IS NULL OR settlement_cycle IS NULL END",
    few="UNBALANCED_JOURNAL:TOO_FEW_POSTINGS IF line_2 IS NULL", repeated="UNBALANCED_JOURNAL:REPEATED_LINE IF line_1 = line_2", amount="UNBALANCED_JOURNAL:AMOUNT_NOT_POSITIVE IF amount_1 <= 0 OR (line_2 IS NOT NULL AND amount_2 <= 0)",
    side="UNBALANCED_JOURNAL:UNKNOWN_SIDE IF side_1 NOT IN ('DEBIT', 'CREDIT') OR (line_2 IS NOT NULL AND side_2 NOT IN ('DEBIT', 'CREDIT'))", sums=f"UNBALANCED_JOURNAL:UNBALANCED IF {_DEBITS} <> {_DEBITS.replace('DEBIT', 'CREDIT')}"))
def admission_journals(s, d):
    """Every broken rule of every planted journal, its postings among them."""
    return admission.row_violations(derived.raw_ledger(s, d), "LEDGER_JOURNALS", registry.DEFAULT)
