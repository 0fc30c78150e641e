"""Independent DuckDB SQL of the registered queries."""

from __future__ import annotations

from concordat.sources.derived import FIRST_DAYS, duckdb_prefix


def _key(prefix: str, *columns: str, **named: str) -> str:
    pairs = sorted({c: c for c in columns} | named)
    every = {c: c for c in columns} | named
    return f"'{prefix}' || sha256('{{' || " + " || ',' || ".join(f"'\"{k}\":\"' || {every[k]} || '\"'" for k in pairs) + " || '}')"


TXN = _key("txn:", "processor", "merchant_id", "payment_id", "event_class", "currency")
STL = _key("stl:", "processor", "merchant_id", "settlement_id", "settlement_cycle", "currency")


def txn(events: str, journals: str, name: str) -> str:
    """CTEs ending in one called name: the full transaction result over the given event and journal relations."""
    return f"""
{name}_cap AS (SELECT * FROM {events} WHERE event_type = 'CAPTURE'),
{name}_neg AS (SELECT n.*, c.source_record_id AS capture_id, c.amount_minor AS capture_minor,
  COALESCE(c.merchant_id = n.merchant_id AND c.payment_id = n.payment_id AND c.currency = n.currency, FALSE) AS in_scope
  FROM {events} n LEFT JOIN {name}_cap c ON c.processor = n.processor AND c.source_record_id = n.reference_event_id WHERE n.event_type <> 'CAPTURE'),
{name}_used AS (SELECT processor, capture_id, CAST(SUM(amount_minor) AS BIGINT) AS applied_minor FROM {name}_neg WHERE in_scope GROUP BY 1, 2),
{name}_ref AS (SELECT n.*, u.applied_minor, NOT in_scope AS unresolved, COALESCE(in_scope AND u.applied_minor > capture_minor, FALSE) AS over_applied
  FROM {name}_neg n LEFT JOIN {name}_used u ON u.processor = n.processor AND u.capture_id = n.capture_id),
{name}_flag AS (SELECT processor, merchant_id, payment_id, event_type AS event_class, currency, bool_or(unresolved) AS unresolved, bool_or(over_applied) AS over_applied FROM {name}_ref GROUP BY ALL),
{name}_p AS (SELECT processor, merchant_id, payment_id, event_type AS event_class, currency, SUM(CASE WHEN event_type = 'CAPTURE' THEN amount_minor ELSE -amount_minor END) AS p, COUNT(*) AS pn FROM {events} GROUP BY ALL),
{name}_l AS (SELECT processor, merchant_id, payment_id, entry_type AS event_class, currency, SUM(CASE WHEN clearing_side = 'DEBIT' THEN amount_minor ELSE -amount_minor END) AS l, COUNT(*) AS ln,
  bool_or(counter_role <> 'MERCHANT_PAYABLE') AS bad FROM {journals} GROUP BY ALL),
{name}_j AS (SELECT processor, merchant_id, payment_id, event_class, currency, CAST(COALESCE(p, 0) AS BIGINT) AS processor_minor, CAST(COALESCE(l, 0) AS BIGINT) AS ledger_minor,
  CAST(COALESCE(p, 0) - COALESCE(l, 0) AS BIGINT) AS processor_ledger_delta_minor, CAST(ABS(COALESCE(p, 0) - COALESCE(l, 0)) AS BIGINT) AS difference_minor,
  COALESCE(pn, 0) AS processor_record_count, COALESCE(ln, 0) AS ledger_journal_count,
  concat_ws('|', CASE WHEN bad THEN 'INVALID_ACCOUNT_ROLE' END, CASE WHEN unresolved THEN 'UNRESOLVED_REFERENCE' END, CASE WHEN over_applied THEN 'OVER_APPLIED_REFERENCE' END,
    CASE WHEN ln IS NULL THEN 'MISSING_LEDGER_MOVEMENT' END, CASE WHEN pn IS NULL THEN 'MISSING_PROCESSOR_ACTIVITY' END) AS owned
  FROM {name}_p FULL JOIN {name}_l USING (processor, merchant_id, payment_id, event_class, currency) LEFT JOIN {name}_flag USING (processor, merchant_id, payment_id, event_class, currency)),
{name} AS (SELECT {TXN} AS reconciliation_key, processor, merchant_id, payment_id, event_class, currency, processor_minor, ledger_minor, processor_ledger_delta_minor, difference_minor,
  processor_record_count, ledger_journal_count, CASE WHEN owned <> '' THEN 'EXCEPTION' WHEN difference_minor = 0 THEN 'MATCHED' WHEN difference_minor <= 0 THEN 'WITHIN_TOLERANCE' ELSE 'EXCEPTION' END AS status,
  CASE WHEN owned <> '' THEN owned WHEN difference_minor = 0 THEN '' WHEN difference_minor <= 0 THEN 'TOLERATED_DIFFERENCE' ELSE 'PROCESSOR_LEDGER_MISMATCH' END AS reason_codes FROM {name}_j)"""


ALLOC = f"""
t_key AS (SELECT processor, merchant_id, settlement_id, settlement_cycle, currency FROM v_settlement UNION SELECT processor, merchant_id, settlement_id, settlement_cycle, currency FROM v_set_journal),
b_once AS (SELECT bank_account_id, bank_record_id, merchant_id, currency, direction, amount_minor, NULLIF(TRIM(settlement_reference), '') AS ref, COUNT(*) AS copies FROM v_bank GROUP BY ALL),
b_named AS (SELECT b.*, t.processor, t.settlement_cycle, t.settlement_id, t.settlement_id IS NOT NULL AS hit, EXISTS (SELECT 1 FROM v_account a WHERE a.merchant_id = b.merchant_id AND a.currency = b.currency AND a.bank_account_id = b.bank_account_id) AS ok
  FROM b_once b LEFT JOIN t_key t ON t.merchant_id = b.merchant_id AND t.currency = b.currency AND t.settlement_id = b.ref),
alloc AS (SELECT bank_account_id, bank_record_id, merchant_id, currency, ref AS normalized_settlement_reference,
  CASE WHEN hit THEN 'ALLOCATED' WHEN ref IS NULL THEN 'UNALLOCATED_MISSING_REFERENCE' ELSE 'UNALLOCATED_UNKNOWN_REFERENCE' END AS disposition,
  CASE WHEN hit THEN {STL} END AS settlement_reconciliation_key, CASE WHEN direction = 'CREDIT' THEN amount_minor ELSE -amount_minor END AS signed_minor,
  CASE WHEN hit THEN ok END AS account_permitted, copies > 1 AS duplicate_current_bundle,
  concat_ws('|', CASE WHEN NOT hit THEN 'UNALLOCATED_BANK_MOVEMENT' END, CASE WHEN hit AND NOT ok THEN 'INVALID_BANK_ACCOUNT' END, CASE WHEN copies > 1 THEN 'DUPLICATE_BANK_MOVEMENT' END) AS reason_codes,
  processor, settlement_cycle, settlement_id FROM b_named)"""
THREE = f"""{ALLOC},
s_p AS (SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, SUM(gross_minor - fee_minor - refund_minor - chargeback_minor - reserve_minor) AS p, COUNT(*) AS pn,
  bool_or(gross_minor - fee_minor - refund_minor - chargeback_minor - reserve_minor <> reported_net_minor) AS formula FROM v_settlement GROUP BY ALL),
s_l AS (SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, SUM(CASE WHEN clearing_side = 'CREDIT' THEN amount_minor ELSE -amount_minor END) AS l, COUNT(*) AS ln, bool_or(counter_role <> 'BANK_CASH') AS role FROM v_set_journal GROUP BY ALL),
s_b AS (SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, SUM(signed_minor) AS b, COUNT(*) AS bn, bool_or(NOT account_permitted) AS account, bool_or(duplicate_current_bundle) AS again FROM alloc WHERE disposition = 'ALLOCATED' GROUP BY ALL),
s_j AS (SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, CAST(COALESCE(p, 0) AS BIGINT) AS p, CAST(COALESCE(l, 0) AS BIGINT) AS l, CAST(COALESCE(b, 0) AS BIGINT) AS b, COALESCE(pn, 0) AS pn, COALESCE(ln, 0) AS ln, COALESCE(bn, 0) AS bn, role, formula, account, again
  FROM s_p FULL JOIN s_l USING (processor, merchant_id, settlement_id, settlement_cycle, currency) LEFT JOIN s_b USING (processor, merchant_id, settlement_id, settlement_cycle, currency)),
s_o AS (SELECT *, GREATEST(ABS(p - l), ABS(p - b), ABS(l - b)) AS d, concat_ws('|', CASE WHEN role THEN 'INVALID_ACCOUNT_ROLE' END, CASE WHEN pn > 0 AND p <> 0 AND ln = 0 THEN 'MISSING_LEDGER_MOVEMENT' END,
  CASE WHEN pn = 0 THEN 'MISSING_PROCESSOR_ACTIVITY' END, CASE WHEN pn > 0 AND p <> 0 AND bn = 0 THEN 'MISSING_BANK_SETTLEMENT' END, CASE WHEN account THEN 'INVALID_BANK_ACCOUNT' END,
  CASE WHEN again THEN 'DUPLICATE_BANK_MOVEMENT' END, CASE WHEN formula THEN 'SETTLEMENT_FORMULA_MISMATCH' END) AS owned,
  concat_ws('|', CASE WHEN p <> l THEN 'PROCESSOR_LEDGER_MISMATCH' END, CASE WHEN p <> b THEN 'PROCESSOR_BANK_MISMATCH' END, CASE WHEN l <> b THEN 'LEDGER_BANK_MISMATCH' END) AS deltas FROM s_j),
three AS (SELECT {STL} AS reconciliation_key, processor, merchant_id, settlement_id, settlement_cycle, currency, p AS processor_net_minor, l AS ledger_clearing_minor, b AS bank_minor, p - l AS processor_ledger_delta_minor,
  p - b AS processor_bank_delta_minor, l - b AS ledger_bank_delta_minor, d AS difference_minor, pn AS processor_settlement_count, ln AS ledger_journal_count, bn AS allocated_bank_entry_count,
  CASE WHEN owned <> '' THEN 'EXCEPTION' WHEN d = 0 THEN 'MATCHED' WHEN d <= 1 THEN 'WITHIN_TOLERANCE' ELSE 'EXCEPTION' END AS status,
  CASE WHEN owned <> '' THEN owned WHEN d = 0 THEN '' WHEN d <= 1 THEN 'TOLERATED_DIFFERENCE' ELSE deltas END AS reason_codes FROM s_o)"""
PREFIX = duckdb_prefix()
FULL = txn("v_event", "v_journal", "recon")
FIRST = f"e1 AS (SELECT * FROM v_event WHERE day < {FIRST_DAYS}), j1 AS (SELECT * FROM v_journal WHERE day < {FIRST_DAYS})," + txn("e1", "j1", "first_run")


def query(select: str, *ctes: str) -> str:
    return ", ".join((PREFIX, *ctes)) + " " + select


HISTORY = """runs AS MATERIALIZED (SELECT reconciliation_key, 1 AS run, status, reason_codes FROM first_run UNION ALL SELECT reconciliation_key, 2, status, reason_codes FROM recon),
history AS MATERIALIZED (SELECT *, 'prf:' || sha256('{"grain":"transaction","manifest_sha256":"m' || run || '","policy_sha256":"policy","reconciliation_key":"' || reconciliation_key || '","revision":' || revision || '}') AS proof_id
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY reconciliation_key ORDER BY run) AS revision FROM runs))"""
TXN_AMOUNTS = ("processor_minor", "ledger_minor", "processor_ledger_delta_minor", "difference_minor", "processor_record_count", "ledger_journal_count")
STL_AMOUNTS = ("processor_net_minor", "ledger_clearing_minor", "bank_minor", "processor_ledger_delta_minor", "processor_bank_delta_minor", "ledger_bank_delta_minor", "difference_minor", "processor_settlement_count", "ledger_journal_count", "allocated_bank_entry_count")


def _summary(relation: str, second: str, amounts: tuple[str, ...]) -> str:
    totals = ", ".join(f"CAST(SUM(CAST({a} AS DECIMAL(38,0))) AS VARCHAR) AS {a}" for a in amounts)
    return f"SELECT currency, {second}, reason_codes, COUNT(*) AS n_rows, {totals} FROM {relation} GROUP BY currency, {second}, reason_codes"


#: Transaction results with the planted contradictions.
PLANTED = """planted AS (SELECT reconciliation_key, processor, CASE WHEN k % 59 = 0 THEN merchant_id || 'x' ELSE merchant_id END AS merchant_id, payment_id, event_class, CASE WHEN k % 53 = 0 THEN lower(currency) ELSE currency END AS currency,
  processor_minor, ledger_minor, processor_ledger_delta_minor + CASE WHEN k % 37 = 0 THEN 1 ELSE 0 END AS processor_ledger_delta_minor, difference_minor, processor_record_count,
  ledger_journal_count - CASE WHEN k % 41 = 0 THEN 9 ELSE 0 END AS ledger_journal_count, CASE WHEN k % 43 = 0 THEN 'MATCHED' WHEN k % 61 = 0 THEN 'UNKNOWN' ELSE status END AS status,
  CASE WHEN k % 47 = 0 THEN 'NO_SUCH_REASON' ELSE reason_codes END AS reason_codes FROM (SELECT *, CAST(substr(payment_id, 5) AS BIGINT) AS k FROM recon))"""
_TXN_REASONS = "['INVALID_ACCOUNT_ROLE','UNRESOLVED_REFERENCE','OVER_APPLIED_REFERENCE','MISSING_LEDGER_MOVEMENT','MISSING_PROCESSOR_ACTIVITY','PROCESSOR_LEDGER_MISMATCH','TOLERATED_DIFFERENCE']"
_STL_ORDER = "['INVALID_ACCOUNT_ROLE','MISSING_LEDGER_MOVEMENT','MISSING_PROCESSOR_ACTIVITY','MISSING_BANK_SETTLEMENT','UNALLOCATED_BANK_MOVEMENT','INVALID_BANK_ACCOUNT','DUPLICATE_BANK_MOVEMENT','SETTLEMENT_FORMULA_MISMATCH','PROCESSOR_LEDGER_MISMATCH','PROCESSOR_BANK_MISMATCH','LEDGER_BANK_MISMATCH']"
_CODES = "CASE WHEN reason_codes = '' THEN [] ELSE string_split(reason_codes, '|') END"
_BAD_CODES = f"len(list_distinct({_CODES})) <> len({_CODES}) OR NOT list_has_all({_TXN_REASONS}, {_CODES})"
ROW_FAULTS = f"""SELECT reconciliation_key, faults FROM (SELECT reconciliation_key, concat_ws('|', CASE WHEN NOT regexp_full_match(currency, '[A-Z]{{3}}') THEN 'CURRENCY' END, CASE WHEN {_BAD_CODES} THEN 'REASONS' END,
  CASE WHEN status NOT IN ('MATCHED','WITHIN_TOLERANCE','EXCEPTION') THEN 'STATUS' END, CASE WHEN processor_ledger_delta_minor <> processor_minor - ledger_minor THEN 'DELTA' END,
  CASE WHEN difference_minor <> ABS(processor_ledger_delta_minor) THEN 'DIFFERENCE' END, CASE WHEN processor_record_count < 0 OR ledger_journal_count < 0 THEN 'COUNT' END,
  CASE WHEN (status = 'MATCHED') <> (difference_minor = 0 AND reason_codes = '') OR (status = 'WITHIN_TOLERANCE') <> (difference_minor > 0 AND reason_codes = 'TOLERATED_DIFFERENCE') THEN 'STATUS_REASON' END,
  CASE WHEN reconciliation_key <> {TXN} THEN 'KEY' END) AS faults FROM planted) WHERE faults <> ''"""
SUMMARY_FAULTS = f"""SELECT currency, status, reason_codes, faults FROM (SELECT currency, status, reason_codes, concat_ws('|', CASE WHEN NOT regexp_full_match(currency, '[A-Z]{{3}}') THEN 'CURRENCY' END, CASE WHEN {_BAD_CODES} THEN 'REASONS' END,
  CASE WHEN status NOT IN ('MATCHED','WITHIN_TOLERANCE','EXCEPTION') THEN 'STATUS' END, CASE WHEN (status = 'MATCHED' AND reason_codes <> '') OR (status = 'WITHIN_TOLERANCE' AND reason_codes <> 'TOLERATED_DIFFERENCE') THEN 'STATUS_REASON' END,
  CASE WHEN SUM(processor_record_count) < 0 OR SUM(ledger_journal_count) < 0 THEN 'COUNT' END) AS faults FROM planted GROUP BY currency, status, reason_codes) WHERE faults <> ''"""
ALLOC_FAULTS = """SELECT DISTINCT bank_account_id, bank_record_id, faults FROM (SELECT bank_account_id, bank_record_id, concat_ws('|', CASE WHEN disposition NOT IN ('ALLOCATED','UNALLOCATED_MISSING_REFERENCE','UNALLOCATED_UNKNOWN_REFERENCE') THEN 'DISPOSITION' END,
  CASE WHEN (disposition = 'ALLOCATED') <> (settlement_reconciliation_key IS NOT NULL) THEN 'TARGET' END, CASE WHEN (disposition = 'ALLOCATED') <> (account_permitted IS NOT NULL) THEN 'PERMISSION' END) AS faults
  FROM (SELECT bank_account_id, bank_record_id, settlement_reconciliation_key, CASE WHEN m % 37 = 0 THEN 'ALLOCATED' WHEN m % 41 = 0 THEN 'LOST' ELSE disposition END AS disposition, CASE WHEN m % 43 = 0 THEN NULL ELSE account_permitted END AS account_permitted
  FROM (SELECT *, length(bank_record_id) + signed_minor AS m FROM alloc))) WHERE faults <> ''"""
_EVENT_JSON = """concat_ws(',', '{"amount_minor":' || amount_minor, '"currency":"' || currency || '"', '"event_type":"' || event_type || '"', '"merchant_id":"' || merchant_id || '"', '"occurred_at":"' || occurred_at || '"',
  '"payment_id":"' || payment_id || '"', '"processor":"' || processor || '"', '"reference_event_id":"' || reference_event_id || '"', '"schema_version":"' || schema_version || '"', '"source_record_id":"' || source_record_id || '"}')"""
_ROW_RULES = {
    "SCHEMA_VIOLATION:received_at is null": "received_at IS NULL", "SCHEMA_VIOLATION:processor is empty or has outer blanks": "processor LIKE '% '",
    "SCHEMA_VIOLATION:unknown event_type": "event_type NOT IN ('CAPTURE','REFUND','CHARGEBACK','REVERSAL')", "SCHEMA_VIOLATION:amount_minor is not positive": "amount_minor <= 0",
    "SCHEMA_VIOLATION:occurred_at is no moment": "TRY_CAST(replace(replace(occurred_at, 'T', ' '), 'Z', '') AS TIMESTAMP) IS NULL", "SCHEMA_VIOLATION:unsupported currency": "currency NOT IN ('INR','JPY','USD')",
    "SCHEMA_VIOLATION:reference": "(event_type = 'CAPTURE') = (reference_event_id IS NOT NULL)", "SOURCE_IDENTITY_MISMATCH:payload digest": f"payload_sha256 <> sha256({_EVENT_JSON})",
}
ADMISSION = " UNION ALL ".join(f"SELECT '{name.partition(':')[0]}' AS rule, 'PROCESSOR_EVENTS' AS family, processor || '/' || source_record_id AS identity, '{name.partition(':')[2]}' AS detail FROM v_raw_record WHERE {test}" for name, test in _ROW_RULES.items())
_RAW = "SELECT processor, source_record_id, COUNT(*) AS n_rows FROM v_raw_event GROUP BY ALL"
_TXN_JSON = "'{\"processor\":\"' || processor || '\",\"merchant_id\":\"' || merchant_id || '\",\"payment_id\":\"' || payment_id || '\",\"event_class\":\"' || event_class || '\",\"currency\":\"' || currency || '\"}'"
_STL_JSON = "'{\"processor\":\"' || processor || '\",\"merchant_id\":\"' || merchant_id || '\",\"settlement_id\":\"' || settlement_id || '\",\"settlement_cycle\":\"' || settlement_cycle || '\",\"currency\":\"' || currency || '\"}'"
_LISTED = "'[' || string_agg(DISTINCT '[\"' || family || '\",\"' || a || '\",\"' || b || '\"]', ',' ORDER BY '[\"' || family || '\",\"' || a || '\",\"' || b || '\"]') || ']'"
TXN_PACKED = f"""SELECT reconciliation_key, {_TXN_JSON} AS key_components, '{{"processor_minor":' || processor_minor || ',"ledger_minor":' || ledger_minor || ',"processor_ledger_delta_minor":' || processor_ledger_delta_minor || ',"difference_minor":' || difference_minor ||
  ',"processor_record_count":' || processor_record_count || ',"ledger_journal_count":' || ledger_journal_count || '}}' AS totals, status, CASE WHEN reason_codes = '' THEN 0 ELSE len(string_split(reason_codes, '|')) END AS n_reasons, source_identities, FALSE AS authoritative_proof
  FROM recon JOIN (SELECT processor, merchant_id, payment_id, event_class, currency, {_LISTED} AS source_identities FROM (
    SELECT processor, merchant_id, payment_id, event_type AS event_class, currency, 'PROCESSOR_EVENT' AS family, processor AS a, source_record_id AS b FROM v_event
    UNION ALL SELECT processor, merchant_id, payment_id, entry_type, currency, 'LEDGER_JOURNAL', 'led', journal_id FROM v_journal) GROUP BY ALL) USING (processor, merchant_id, payment_id, event_class, currency)"""
STL_PACKED = f"""SELECT reconciliation_key, {_STL_JSON} AS key_components, difference_minor, status, source_identities
  FROM three JOIN (SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, {_LISTED} AS source_identities FROM (
    SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, 'PROCESSOR_SETTLEMENT' AS family, processor AS a, source_record_id AS b FROM v_settlement
    UNION ALL SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, 'LEDGER_JOURNAL', 'led', journal_id FROM v_set_journal
    UNION ALL SELECT processor, merchant_id, settlement_id, settlement_cycle, currency, 'BANK_ENTRY', bank_account_id, bank_record_id FROM alloc WHERE disposition = 'ALLOCATED') GROUP BY ALL) USING (processor, merchant_id, settlement_id, settlement_cycle, currency)"""
SIGNED = "CASE WHEN event_type = 'CAPTURE' THEN amount_minor ELSE -amount_minor END"


CASE_ID = """'case:' || sha256('{"grain":"transaction","initial_exception_proof_id":"' || COALESCE(b.proof_id, a.proof_id) || '","reconciliation_key":"' || reconciliation_key || '"}')"""
ORACLES: dict[str, str] = {
    "txn_recon": query("SELECT * FROM recon", FULL),
    "txn_unresolved_refs": query("SELECT processor, source_record_id, reference_event_id, event_type FROM recon_ref WHERE unresolved", FULL),
    "txn_capture_capacity": query("SELECT c.processor, c.source_record_id AS capture_id, c.amount_minor AS captured_minor, COALESCE(u.applied_minor, 0) AS applied_minor, c.amount_minor - COALESCE(u.applied_minor, 0) AS remaining_minor, CASE WHEN u.applied_minor > c.amount_minor THEN 'OVER_APPLIED' ELSE 'VALID' END AS verdict FROM recon_cap c LEFT JOIN recon_used u ON c.processor = u.processor AND c.source_record_id = u.capture_id", FULL),
    "journal_movement": query("SELECT journal_id, CASE WHEN clearing_side = 'DEBIT' THEN amount_minor ELSE -amount_minor END AS movement_minor, counter_role <> 'MERCHANT_PAYABLE' AS invalid_role FROM v_journal"),
    "journal_balance_violations": query("SELECT journal_id, broken FROM (SELECT journal_id, concat_ws('|', CASE WHEN COUNT(*) < 2 THEN 'TOO_FEW_POSTINGS' END, CASE WHEN COUNT(DISTINCT line_id) < COUNT(*) THEN 'REPEATED_LINE' END, CASE WHEN MIN(amount_minor) <= 0 THEN 'AMOUNT_NOT_POSITIVE' END, CASE WHEN bool_or(side NOT IN ('DEBIT', 'CREDIT')) THEN 'UNKNOWN_SIDE' END, CASE WHEN COALESCE(SUM(amount_minor) FILTER (side = 'DEBIT'), 0) <> COALESCE(SUM(amount_minor) FILTER (side = 'CREDIT'), 0) THEN 'UNBALANCED' END) AS broken FROM v_raw_posting GROUP BY journal_id) WHERE broken <> ''"),
    "stl_net": query("SELECT source_record_id, gross_minor - fee_minor - refund_minor - chargeback_minor - reserve_minor AS net_minor, gross_minor - fee_minor - refund_minor - chargeback_minor - reserve_minor <> reported_net_minor AS formula_mismatch FROM v_settlement"),
    "stl_three_way": query("SELECT * FROM three", THREE),
    "bank_allocation": query("SELECT * EXCLUDE (processor, settlement_cycle, settlement_id) FROM alloc", ALLOC),
    "bank_duplicates": query("SELECT bank_account_id, bank_record_id, copies FROM b_once WHERE copies > 1", ALLOC),
    "ambiguous_refs": query("SELECT merchant_id, currency, settlement_id, COUNT(*) AS n_targets FROM (SELECT DISTINCT * FROM v_raw_target) GROUP BY ALL HAVING COUNT(*) > 1"),
    "settlement_targets": query("SELECT * FROM t_key", ALLOC),
    "identity_conflicts": query("SELECT processor, source_record_id, COUNT(*) AS n_rows FROM v_raw_event GROUP BY ALL HAVING COUNT(DISTINCT payload_sha256) > 1"),
    "replay_dedup": query("SELECT processor, event_type, COUNT(*) AS n_once, CAST(SUM(amount_minor) AS BIGINT) AS amount_minor FROM (SELECT DISTINCT processor, source_record_id, event_type, amount_minor, payload_sha256 FROM v_raw_event) GROUP BY ALL"),
    "replay_order": query("SELECT source_record_id, processor, line, ROW_NUMBER() OVER w AS occurrence, ROW_NUMBER() OVER w > 1 AS replayed FROM v_raw_event WINDOW w AS (PARTITION BY processor, source_record_id ORDER BY line)"),
    "currency_domain": query("SELECT processor, merchant_id, payment_id, event_type, COUNT(DISTINCT currency) AS n_currencies FROM v_raw_event GROUP BY ALL HAVING COUNT(DISTINCT currency) > 1"),
    "missing_side": query("SELECT reconciliation_key, CASE WHEN ledger_journal_count = 0 THEN 'LEDGER' ELSE 'PROCESSOR' END AS missing FROM recon WHERE ledger_journal_count = 0 OR processor_record_count = 0", FULL),
    "summary_transactions": query(_summary("recon", "status", TXN_AMOUNTS), FULL),
    "summary_settlements": query(_summary("three", "status", STL_AMOUNTS), THREE),
    "summary_allocations": query(_summary("alloc", "disposition", ("signed_minor",)), ALLOC),
    "control_totals": query("SELECT currency, CAST(SUM(processor_net_minor) AS VARCHAR) AS processor_total, CAST(SUM(ledger_clearing_minor) AS VARCHAR) AS ledger_total, CAST(SUM(bank_minor) AS VARCHAR) AS bank_total FROM three GROUP BY currency", THREE),
    "batch_verdict": query(f"SELECT CASE WHEN len(r) > 0 THEN 'EXCEPTION' WHEN t THEN 'WITHIN_TOLERANCE' ELSE 'MATCHED' END AS batch_status, CASE WHEN len(r) = 0 AND t THEN 'TOLERATED_DIFFERENCE' ELSE array_to_string(r, '|') END AS reason_codes FROM (SELECT list_filter({_STL_ORDER}, lambda x: list_contains(c, x)) AS r, list_contains(c, 'TOLERATED_DIFFERENCE') AS t FROM (SELECT list(DISTINCT u) AS c FROM (SELECT unnest(string_split(reason_codes, '|')) AS u FROM (SELECT reason_codes FROM three UNION ALL SELECT reason_codes FROM alloc)) WHERE u <> ''))", THREE),
    "table_fingerprint": query("SELECT COUNT(*) AS n_rows, MIN(d) AS least, MAX(d) AS greatest, " + ", ".join(f"CAST(SUM(CAST(('0x' || substr(d, {12 * i + 1}, 12)) AS BIGINT)) AS VARCHAR) AS sum_{i}" for i in range(5)) + """ FROM (SELECT sha256('{"difference_minor":' || difference_minor || ',"reconciliation_key":"' || reconciliation_key || '","status":"' || status || '"}') AS d FROM recon)""", FULL),
    "recon_diff": query("SELECT reconciliation_key, status, CASE WHEN b > 0 THEN 'expected' ELSE 'actual' END AS side FROM (SELECT reconciliation_key, status, SUM(e) AS b FROM (SELECT reconciliation_key, status, 1 AS e FROM first_run UNION ALL SELECT reconciliation_key, status, -1 FROM recon) GROUP BY ALL) WHERE b <> 0", FULL, FIRST),
    "derived_keys": query(f"SELECT DISTINCT {TXN.replace('event_class', 'event_type').replace('event_type' + chr(34), 'event_class' + chr(34))} AS reconciliation_key FROM v_event"),
    "revision_chain": query("SELECT reconciliation_key, revision, proof_id, ROW_NUMBER() OVER w AS position, LAG(proof_id) OVER w AS predecessor_id FROM history WINDOW w AS (PARTITION BY reconciliation_key ORDER BY revision)", FULL, FIRST, HISTORY),
    "latest_heads": query("SELECT reconciliation_key, revision, proof_id, status, reason_codes FROM history QUALIFY ROW_NUMBER() OVER (PARTITION BY reconciliation_key ORDER BY revision DESC) = 1", FULL, FIRST, HISTORY),
    "case_transitions": query(f"SELECT reconciliation_key, {CASE_ID} AS case_id, CASE WHEN a.status = 'EXCEPTION' THEN 'OPEN' ELSE 'RESOLVED_BY_LATE_DATA' END AS case_status, CASE WHEN b.proof_id IS NULL THEN 1 ELSE 2 END AS case_revision, CASE WHEN a.status = 'EXCEPTION' THEN a.reason_codes ELSE b.reason_codes END AS reason_codes FROM (SELECT * FROM history WHERE run = 2) a LEFT JOIN (SELECT * FROM history WHERE run = 1 AND status = 'EXCEPTION') b USING (reconciliation_key) WHERE b.proof_id IS NOT NULL OR a.status = 'EXCEPTION'", FULL, FIRST, HISTORY),
    "state_containment": query("SELECT m.source_record_id, m.processor FROM v_movement m ANTI JOIN (SELECT source_record_id, processor, amount_minor + CASE WHEN k % 89 = 0 THEN 5 ELSE 0 END AS amount_minor FROM v_event) e ON e.source_record_id = m.source_record_id AND e.processor = m.processor AND e.amount_minor = m.amount_minor"),
    "row_semantic_check": query(ROW_FAULTS, FULL, PLANTED),
    "event_windows": "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, COUNT(*) AS n_events FROM events GROUP BY ALL",
    "txn_packed": query(TXN_PACKED, FULL),
    "stl_packed": query(STL_PACKED, THREE),
    "admission_rows": query(ADMISSION),
    "policy_accounts": query("SELECT merchant_id, currency, a.bank_account_id IS NOT NULL AS permitted, COUNT(*) AS n_entries FROM v_bank b LEFT JOIN v_account a USING (merchant_id, currency, bank_account_id) GROUP BY ALL"),
    "replay_counts": query(f"SELECT CAST(SUM(n_rows) AS BIGINT) AS n_rows, COUNT(*) AS n_identities, CAST(SUM(n_rows) AS BIGINT) - COUNT(*) AS n_replayed FROM ({_RAW})"),
    "summary_difference": query(f"SELECT currency, status, reason_codes, n_rows, difference_minor, 'expected' AS side FROM (({_summary('recon', 'status', TXN_AMOUNTS)}) EXCEPT ({_summary('planted', 'status', TXN_AMOUNTS)})) UNION ALL SELECT currency, status, reason_codes, n_rows, difference_minor, 'actual' FROM (({_summary('planted', 'status', TXN_AMOUNTS)}) EXCEPT ({_summary('recon', 'status', TXN_AMOUNTS)}))", FULL, PLANTED),
    "summary_semantic_check": query(SUMMARY_FAULTS, FULL, PLANTED),
    "control_totals_unequal": query("SELECT currency FROM three GROUP BY currency HAVING SUM(processor_net_minor) <> SUM(ledger_clearing_minor) OR SUM(processor_net_minor) <> SUM(bank_minor)", THREE),
    "state_merge": query(f"SELECT CASE WHEN p.a IS NULL THEN 'DISTINCT' WHEN p.a = r.payload_sha256 THEN 'REPLAY' ELSE 'CONFLICT' END AS replay_class, COUNT(*) AS n_rows FROM v_raw_event r LEFT JOIN (SELECT processor, source_record_id, payload_sha256 AS a FROM v_raw_event WHERE part = 0 AND day < {FIRST_DAYS}) p USING (processor, source_record_id) WHERE part <> 3 GROUP BY ALL UNION ALL SELECT 'MERGED', COUNT(*) FROM (SELECT DISTINCT processor, source_record_id FROM v_raw_event WHERE part = 0)"),
    "allocation_semantic_check": query(ALLOC_FAULTS, ALLOC),
    "merchant_rollup": query("SELECT e.*, COALESCE(b.n_deposits, 0) AS n_deposits FROM (SELECT merchant_id, currency, COUNT(*) AS n_events, CAST(SUM(amount_minor) AS BIGINT) AS amount_minor, CAST(SUM(CASE WHEN event_type <> 'CAPTURE' THEN amount_minor ELSE 0 END) AS BIGINT) AS applied_minor FROM v_event GROUP BY ALL) e LEFT JOIN (SELECT merchant_id, currency, COUNT(*) AS n_deposits FROM v_bank GROUP BY ALL) b USING (merchant_id, currency)"),
    "gross_charges": query(f"SELECT currency, CAST(SUM(CASE WHEN {SIGNED} > 0 THEN {SIGNED} ELSE 0 END) AS BIGINT) AS charged_minor, CAST(SUM(CASE WHEN {SIGNED} < 0 THEN -({SIGNED}) ELSE 0 END) AS BIGINT) AS excluded_minor, COUNT(*) FILTER ({SIGNED} < 0) AS n_excluded FROM v_event GROUP BY currency"),
    "family_counts": query(" UNION ALL ".join(f"SELECT '{f}' AS family, COUNT(*) AS n_rows FROM {v}" for f, v in (("PROCESSOR_EVENTS", "v_event"), ("LEDGER_JOURNALS", "v_journal"), ("PROCESSOR_SETTLEMENTS", "v_settlement"), ("BANK_ENTRIES", "v_bank")))),
    "scalar_functions": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '-' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS amount, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS decoded, CAST(CAST('0x' || substr(sha256('seed' || chr(31) || o_orderkey), 1, 16) AS UBIGINT) AS VARCHAR) AS counter, 'evt-' || substr(sha256('seed' || chr(31) || o_orderkey), 1, 32) AS identifier, strftime(TIMESTAMP '2026-01-01 00:00:00' + to_seconds(o_orderkey % 86400), '%Y-%m-%dT%H:%M:%SZ') AS moment FROM orders",
}
