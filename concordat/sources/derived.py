"""Payment families derived from the star schema, written once as SQL text for Spark and DuckDB.

``{div}`` is integer division, ``{month}`` the year and month of an order's date, ``{oday}`` and
``{lday}`` the days of order and shipment since 1992, ``{sha}x{ahs}`` a SHA-256 in hex; everything else
is common to both dialects. Faults (missing, wrong or repeated evidence) follow fixed moduli. Views
named raw hold, besides the records, replays and faults of every kind that admission refuses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.sources.scratch import written
from concordat.sources.tables import table

def json_text(texts: tuple[str, ...], numbers: tuple[str, ...] = (), **written: str) -> str:
    """SQL for a flat record's canonical JSON without its braces: members by name, nulls left out; written holds members as SQL."""
    members = {c: f"'\"{c}\":\"' || {c} || '\"'" for c in texts} | {c: f"'\"{c}\":' || CAST({c} AS STRING)" for c in numbers} | written
    return f"concat_ws(',', {', '.join(members[c] for c in sorted(members))})"


def _posting(i: int) -> str:
    return f"""'{{{{"account_role":"' || role_{i} || '","amount_minor":' || CAST(amount_{i} AS STRING) || ',"line_id":"' || line_{i} || '","side":"' || side_{i} || '"}}}}'"""


# Members of the records' canonical JSON; a journal's second posting is left out where it has none.
SETTLEMENT_JSON = json_text(("schema_version", "source_record_id", "processor", "merchant_id", "settlement_id", "settlement_cycle", "currency", "occurred_at"), ("gross_minor", "fee_minor", "refund_minor", "chargeback_minor", "reserve_minor", "reported_net_minor"))
BANK_JSON = json_text(("schema_version", "bank_record_id", "bank_account_id", "merchant_id", "settlement_reference", "direction", "currency", "value_at"), ("amount_minor",))
LEDGER_JSON = json_text(("schema_version", "ledger_system", "journal_id", "processor", "merchant_id", "payment_id", "settlement_id", "settlement_cycle", "entry_type", "currency", "effective_at"), postings=f"""'"postings":[' || concat_ws(',', {_posting(1)}, {_posting(2)}) || ']'""")


def _digested(view: str, json: str, m: int) -> str:
    """A view with payload digests, wrong where the mark is divisible by m."""
    return f"""SELECT *, {{sha}}CASE WHEN mark % {m} = 0 THEN 'x' ELSE '' END || '{{{{' || {json} || '}}}}'{{ahs}} AS payload_sha256 FROM {view}"""


VIEWS: dict[str, str] = {
    "v_customer": """SELECT c_custkey, c_nationkey, CASE c_nationkey % 3 WHEN 0 THEN 'INR' WHEN 1 THEN 'JPY' ELSE 'USD' END AS currency,
        'm-' || CAST(c_nationkey AS STRING) AS merchant_id FROM customer""",
    "v_order": """SELECT o_orderkey, 'p-' || CAST(o_custkey % 2 AS STRING) AS processor, merchant_id, 'pay-' || CAST(o_orderkey AS STRING) AS payment_id,
        currency, {month} AS cycle, {oday} AS day, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount FROM orders JOIN v_customer ON o_custkey = c_custkey""",
    "v_movement": """SELECT 'cap-' || CAST(o_orderkey AS STRING) AS source_record_id, processor, merchant_id, payment_id, 'CAPTURE' AS event_type, amount AS amount_minor,
        currency, CAST(NULL AS STRING) AS reference_event_id, cycle, o_orderkey AS k, day FROM v_order
        UNION ALL SELECT 'neg-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' ||
        CAST(CAST(l_quantity AS BIGINT) AS STRING) || '-' || CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING), processor, merchant_id, payment_id,
        CASE WHEN l_returnflag = 'R' THEN 'REFUND' WHEN l_linestatus = 'F' THEN 'CHARGEBACK' ELSE 'REVERSAL' END, CAST(ROUND(l_extendedprice * 100) AS BIGINT), currency,
        CASE WHEN (l_orderkey + l_linenumber + l_partkey) % 103 = 0 THEN 'cap-x' ELSE 'cap-' || CAST(l_orderkey AS STRING) END, cycle, l_orderkey + l_linenumber + l_partkey, {lday}
        FROM lineitem JOIN v_order ON l_orderkey = o_orderkey WHERE l_returnflag IN ('R', 'A')""",
    "v_event": "SELECT * FROM v_movement WHERE k % 101 <> 0",
    "v_journal": """SELECT 'led' AS ledger_system, 'jrn-' || source_record_id AS journal_id, processor, merchant_id, payment_id, event_type AS entry_type, currency,
        amount_minor - CASE WHEN k % 89 = 0 THEN 1 ELSE 0 END AS amount_minor, CASE WHEN event_type = 'CAPTURE' THEN 'DEBIT' ELSE 'CREDIT' END AS clearing_side,
        CASE WHEN k % 83 = 0 THEN 'BANK_CASH' ELSE 'MERCHANT_PAYABLE' END AS counter_role, k, day + CAST(k % 40 AS INT) AS day FROM v_movement WHERE k % 97 <> 0""",
    "v_sum": """SELECT processor, merchant_id, cycle, currency, CAST(SUM(CASE WHEN event_type = 'CAPTURE' THEN amount_minor ELSE 0 END) AS BIGINT) AS gross_minor,
        CAST(SUM(CASE WHEN event_type = 'REFUND' THEN amount_minor ELSE 0 END) AS BIGINT) AS refund_minor,
        CAST(SUM(CASE WHEN event_type IN ('CHARGEBACK', 'REVERSAL') THEN amount_minor ELSE 0 END) AS BIGINT) AS chargeback_minor
        FROM v_event GROUP BY processor, merchant_id, cycle, currency""",
    "v_net": """SELECT *, 'set-' || processor || '-' || merchant_id || '-' || cycle AS settlement_id, gross_minor {div} 100 AS fee_minor, gross_minor {div} 200 AS reserve_minor,
        gross_minor - gross_minor {div} 100 - refund_minor - chargeback_minor - gross_minor {div} 200 AS net_minor FROM v_sum""",
    "v_settlement": """SELECT 'rec-' || settlement_id AS source_record_id, processor, merchant_id, settlement_id, cycle AS settlement_cycle, currency, gross_minor, fee_minor, refund_minor,
        chargeback_minor, reserve_minor, net_minor + CASE WHEN gross_minor % 53 = 0 THEN 1 ELSE 0 END AS reported_net_minor FROM v_net WHERE gross_minor % 59 <> 0""",
    "v_set_journal": """SELECT 'led' AS ledger_system, 'jrn-' || settlement_id AS journal_id, processor, merchant_id, settlement_id, cycle AS settlement_cycle,
        CASE gross_minor % 3 WHEN 0 THEN 'SETTLEMENT' WHEN 1 THEN 'FEE' ELSE 'RESERVE' END AS entry_type, currency,
        ABS(net_minor) + CASE WHEN gross_minor % 43 = 0 THEN 1 ELSE 0 END + CASE WHEN gross_minor % 13 = 0 THEN 1 ELSE 0 END AS amount_minor, CASE WHEN net_minor > 0 THEN 'CREDIT' ELSE 'DEBIT' END AS clearing_side,
        CASE WHEN gross_minor % 47 = 0 THEN 'PROCESSOR_FEES' ELSE 'BANK_CASH' END AS counter_role FROM v_net WHERE net_minor <> 0 AND gross_minor % 41 <> 0""",
    "v_bank": """SELECT 'bk-' || settlement_id || '-' || CAST(part AS STRING) AS bank_record_id, CASE WHEN gross_minor % 29 = 0 THEN 'bank-other' WHEN gross_minor % 3 = 0 THEN 'acct-' || merchant_id ELSE 'bank-' || merchant_id || '-' || currency END AS bank_account_id,
        merchant_id, CASE WHEN gross_minor % 31 = 0 THEN NULL WHEN gross_minor % 37 = 0 THEN 'x-' || settlement_id WHEN gross_minor % 5 = 0 THEN '  ' || settlement_id || ' ' ELSE settlement_id END AS settlement_reference,
        CASE WHEN net_minor > 0 THEN 'CREDIT' ELSE 'DEBIT' END AS direction, currency,
        CASE WHEN gross_minor % 10 <> 0 THEN ABS(net_minor) WHEN part = 1 THEN ABS(net_minor) {div} 2 ELSE ABS(net_minor) - ABS(net_minor) {div} 2 END AS amount_minor
        FROM v_net, (SELECT 1 AS part, 0 AS again UNION ALL SELECT 2, 0 UNION ALL SELECT 1, 1) parts
        WHERE net_minor <> 0 AND (part = 1 OR gross_minor % 10 = 0) AND (again = 0 OR gross_minor % 23 = 0)""",
    "v_account": """SELECT DISTINCT merchant_id, currency, 'bank-' || merchant_id || '-' || currency AS bank_account_id FROM v_customer WHERE c_nationkey % 11 <> 0
        UNION ALL SELECT DISTINCT merchant_id, currency, 'acct-' || merchant_id FROM v_customer""",
    "v_record": """SELECT '2.0' AS schema_version, source_record_id, 'b-' || CAST(k % 7 AS STRING) AS source_batch_id, CASE WHEN k % 307 = 0 THEN processor || ' ' ELSE processor END AS processor, merchant_id, payment_id,
        CASE WHEN k % 311 = 0 THEN 'VOID' ELSE event_type END AS event_type, CASE WHEN k % 313 = 0 THEN -amount_minor ELSE amount_minor END AS amount_minor,
        CASE WHEN k % 317 = 0 THEN 'EUR' ELSE currency END AS currency, CASE WHEN k % 331 = 0 THEN '2020-13-01T00:00:00Z' ELSE '2020-01-01T00:00:00Z' END AS occurred_at,
        CASE WHEN k % 337 = 0 THEN NULL ELSE '2020-01-01T00:00:00.5+00:00' END AS received_at, CASE WHEN k % 347 = 0 THEN 'cap-q' WHEN k % 349 = 0 THEN NULL ELSE reference_event_id END AS reference_event_id, k FROM v_movement""",
    "v_raw_record": """SELECT *, {sha}'{{"amount_minor":' || CAST(amount_minor + CASE WHEN k % 353 = 0 THEN 1 ELSE 0 END AS STRING) || ',"currency":"' || currency || '","event_type":"' || event_type || '","merchant_id":"' || merchant_id ||
        '","occurred_at":"' || occurred_at || '","payment_id":"' || payment_id || '","processor":"' || processor || COALESCE('","reference_event_id":"' || reference_event_id, '') ||
        '","schema_version":"2.0","source_record_id":"' || source_record_id || '"}}'{ahs} AS payload_sha256 FROM v_record""",
    "v_raw_event": """SELECT e.*, {sha}CAST(amount_minor AS STRING) || currency{ahs} AS payload_sha256, k * 10 + part AS line FROM (
        SELECT source_record_id, processor, merchant_id, payment_id, event_type, amount_minor + CASE WHEN part = 2 THEN 1 ELSE 0 END AS amount_minor,
        CASE WHEN part = 3 THEN 'EUR' ELSE currency END AS currency, reference_event_id, cycle, k, day, part
        FROM v_movement, (SELECT 0 AS part UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) parts
        WHERE part = 0 OR (part = 1 AND k % 17 = 0) OR (part = 2 AND k % 401 = 0) OR (part = 3 AND k % 409 = 0)) e""",
    "v_raw_posting": """SELECT journal_id, CASE WHEN side = 1 OR k % 67 = 0 THEN 'l1' ELSE 'l2' END AS line_id, CASE WHEN side = 1 THEN 'PROCESSOR_CLEARING' ELSE counter_role END AS account_role,
        CASE WHEN k % 73 = 0 AND side = 2 THEN 'LEFT' WHEN (clearing_side = 'DEBIT') = (side = 1) THEN 'DEBIT' ELSE 'CREDIT' END AS side,
        CASE WHEN k % 71 = 0 THEN CAST(0 AS BIGINT) WHEN k % 79 = 0 AND side = 2 THEN amount_minor + 1 ELSE amount_minor END AS amount_minor
        FROM v_journal, (SELECT 1 AS side UNION ALL SELECT 2) sides WHERE side = 1 OR k % 61 <> 0""",
    "v_raw_target": "SELECT processor, merchant_id, 'set-' || merchant_id || '-' || cycle AS settlement_id, cycle AS settlement_cycle, currency FROM v_net WHERE gross_minor % 2 = 0",
    "v_settlement_record": """SELECT CASE WHEN gross_minor % 107 = 0 THEN '1.0' ELSE '2.0' END AS schema_version, 'b-1' AS source_batch_id, 'rec-' || settlement_id AS source_record_id,
        CASE WHEN gross_minor % 109 = 0 THEN processor || ' ' ELSE processor END AS processor, CASE WHEN gross_minor % 113 = 0 THEN '' ELSE merchant_id END AS merchant_id, settlement_id, cycle AS settlement_cycle,
        CASE WHEN gross_minor % 127 = 0 THEN 'EUR' ELSE currency END AS currency, gross_minor, CASE WHEN gross_minor % 131 = 0 THEN -fee_minor - 1 ELSE fee_minor END AS fee_minor, refund_minor, chargeback_minor,
        CASE WHEN gross_minor % 137 = 0 THEN NULL ELSE reserve_minor END AS reserve_minor, net_minor AS reported_net_minor, CASE WHEN gross_minor % 139 = 0 THEN '2020-02-30T00:00:00Z' ELSE '2020-01-01T00:00:00Z' END AS occurred_at,
        CASE WHEN gross_minor % 149 = 0 THEN NULL ELSE '2020-01-01T00:00:00.5+00:00' END AS received_at, gross_minor AS mark FROM v_net""",
    "v_raw_settlement": _digested("v_settlement_record", SETTLEMENT_JSON, 151),
    "v_bank_record": """SELECT CASE WHEN amount_minor % 107 = 0 THEN '1.0' ELSE '2.0' END AS schema_version, 'b-1' AS source_batch_id, bank_record_id, CASE WHEN amount_minor % 109 = 0 THEN '' ELSE bank_account_id END AS bank_account_id,
        CASE WHEN amount_minor % 113 = 0 THEN ' ' || merchant_id ELSE merchant_id END AS merchant_id, settlement_reference, CASE WHEN amount_minor % 127 = 0 THEN 'LEFT' ELSE direction END AS direction,
        CASE WHEN amount_minor % 131 = 0 THEN NULL ELSE currency END AS currency, CASE WHEN amount_minor % 137 = 0 THEN CAST(0 AS BIGINT) ELSE amount_minor END AS amount_minor,
        CASE WHEN amount_minor % 139 = 0 THEN '2020-01-01 00:00:00Z' ELSE '2020-01-01T00:00:00Z' END AS value_at, CASE WHEN amount_minor % 149 = 0 THEN NULL ELSE '2020-01-01T00:00:00.5+00:00' END AS received_at, amount_minor AS mark FROM v_bank""",
    "v_raw_bank": _digested("v_bank_record", BANK_JSON, 151),
    "v_ledger_record": """SELECT '2.0' AS schema_version, CASE WHEN mark % 307 = 0 THEN ' led' ELSE ledger_system END AS ledger_system, journal_id, 'b-1' AS source_batch_id, processor, merchant_id,
        CASE WHEN mark % 311 = 0 THEN NULL ELSE payment_id END AS payment_id, settlement_id, CASE WHEN mark % 29 = 0 THEN NULL ELSE settlement_cycle END AS settlement_cycle, CASE WHEN mark % 313 = 0 THEN 'VOID' ELSE entry_type END AS entry_type,
        CASE WHEN mark % 317 = 0 THEN 'EUR' ELSE currency END AS currency, CASE WHEN mark % 331 = 0 THEN '2020-13-01T00:00:00Z' ELSE '2020-01-01T00:00:00Z' END AS effective_at,
        CASE WHEN mark % 337 = 0 THEN NULL ELSE '2020-01-01T00:00:00.5+00:00' END AS received_at, 'l1' AS line_1, 'PROCESSOR_CLEARING' AS role_1, clearing_side AS side_1, CASE WHEN mark % 347 = 0 THEN CAST(0 AS BIGINT) ELSE amount_minor END AS amount_1,
        CASE WHEN mark % 349 = 0 THEN NULL WHEN mark % 353 = 0 THEN 'l1' ELSE 'l2' END AS line_2, counter_role AS role_2, CASE WHEN mark % 359 = 0 THEN 'LEFT' WHEN clearing_side = 'DEBIT' THEN 'CREDIT' ELSE 'DEBIT' END AS side_2,
        amount_minor + CASE WHEN mark % 367 = 0 THEN 1 ELSE 0 END AS amount_2, mark FROM (
        SELECT ledger_system, journal_id, processor, merchant_id, payment_id, CAST(NULL AS STRING) AS settlement_id, CAST(NULL AS STRING) AS settlement_cycle, entry_type, currency, amount_minor, clearing_side, counter_role, k AS mark FROM v_journal
        UNION ALL SELECT ledger_system, journal_id, processor, merchant_id, CAST(NULL AS STRING), settlement_id, settlement_cycle, entry_type, currency, amount_minor, clearing_side, counter_role, amount_minor FROM v_set_journal)""",
    "v_raw_ledger": _digested("v_ledger_record", LEDGER_JSON, 373),
}
DIALECTS = {
    "spark": {"div": "DIV", "month": "date_format(o_orderdate, 'yyyy-MM')", "oday": "datediff(o_orderdate, DATE'1992-01-01')", "lday": "datediff(l_shipdate, DATE'1992-01-01')", "sha": "sha2(", "ahs": ", 256)"},
    "duckdb": {"div": "//", "month": "strftime(o_orderdate, '%Y-%m')", "oday": "CAST(datediff('day', DATE '1992-01-01', o_orderdate) AS INTEGER)", "lday": "CAST(datediff('day', DATE '1992-01-01', l_shipdate) AS INTEGER)", "sha": "sha256(", "ahs": ")"},
}
NEEDS = ("customer", "orders", "lineitem")
#: A first bundle holds what was shipped, ordered or posted before this day.
FIRST_DAYS = 2000


def duckdb_prefix() -> str:
    """WITH clause of all views for DuckDB; those that several others read are computed once."""
    views = {k: v.format(**DIALECTS["duckdb"]).replace("AS STRING", "AS VARCHAR") for k, v in VIEWS.items()}
    return "WITH " + ",\n".join(f"{k} AS {'MATERIALIZED ' if k in ('v_movement', 'v_event', 'v_net') else ''}({v})" for k, v in views.items())


class Stored(str):
    """A data folder with views that are tables already."""

    views: dict[str, DataFrame]


def stored(spark: SparkSession, sf_dir: str, *names: str) -> Stored:
    """The folder with these views written once, for queries that read them several times; the tables stay, for the queries' frames read them."""
    out = Stored(sf_dir)
    out.views = {}
    for name in names:
        out.views[name] = written(_view(spark, out, name), name)
    return out


def _view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready = getattr(sf_dir, "views", {})
    frames = {t: table(spark, sf_dir, t) for t in NEEDS} | ready
    text = "WITH " + ", ".join(f"{t} AS (SELECT * FROM {{{t}}})" for t in frames)
    for k, v in VIEWS.items():
        if k in ready:
            continue
        own = v.format(**DIALECTS["spark"]).replace("{", "{{").replace("}", "}}")
        text += f", {k} AS ({own})"
        if k == name:
            break
    return spark.sql(f"{text} SELECT * FROM {name}", **frames)


def _postings(df: DataFrame) -> DataFrame:
    """Two balanced postings: the clearing side and its counterpart."""
    other = F.when(F.col("clearing_side") == "DEBIT", "CREDIT").otherwise("DEBIT")
    line = lambda i, role, side: F.struct(F.lit(f"l{i}").alias("line_id"), role.alias("account_role"), side.alias("side"), F.col("amount_minor"))
    rows = F.array(line(1, F.lit("PROCESSOR_CLEARING"), F.col("clearing_side")), line(2, F.col("counter_role"), other))
    return df.withColumn("postings", rows).drop("clearing_side", "counter_role", "amount_minor")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view with planted faults, by its name after v_raw_."""
    return _view(spark, sf_dir, f"v_raw_{name}")


def raw_journals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journals with faulty postings; a journal has two at most."""
    line = F.struct("line_id", "account_role", "side", "amount_minor")
    return raw(spark, sf_dir, "posting").groupBy("journal_id").agg(F.collect_list(line).alias("postings"))


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Journal records with faults in their fields, keys and postings; one posting where the second has no line."""
    rows = raw(spark, sf_dir, "ledger").drop("mark")
    line = lambda i: F.struct(*(F.col(f"{c}_{i}").alias(name) for c, name in (("line", "line_id"), ("role", "account_role"), ("side", "side"), ("amount", "amount_minor"))))
    parts = [f"{c}_{i}" for i in (1, 2) for c in ("line", "role", "side", "amount")]
    return rows.withColumn("postings", F.when(F.col("line_2").isNull(), F.array(line(1))).otherwise(F.array(line(1), line(2)))).drop(*parts)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "v_account")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "v_event")


def journals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _postings(_view(spark, sf_dir, "v_journal"))


def settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "v_settlement")


def settlement_journals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _postings(_view(spark, sf_dir, "v_set_journal"))


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "v_bank")
