"""The result of each query in ANSI SQL, written from the rules and not from the Spark plans.

The history in particular is built run by run, as three statements would do it: close what
differs, insert what has no current row, mark what is gone.
"""

from __future__ import annotations

from regchron.functions import checks as K
from regchron.schema import (
    CANTONS,
    HASH_COLUMNS,
    OPEN_END,
    REGISTRY_COLUMNS,
    STATUS_LABEL_DEFAULT,
    STATUS_LABELS,
    UNFINISHED_STATES,
    WHITESPACE,
)

ORACLE: dict[str, str] = {}

RUNS = list(range(1995, 2002))
COLS = ", ".join(REGISTRY_COLUMNS)
VERSION = (
    "egid, gstat, ganzwhg, strname, gdat, valid_from, valid_to, is_current, record_hash, "
    "dqa_deleted, _silver_loaded"
)
OPEN = f"TIMESTAMP '{OPEN_END}'"
SPACES = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _label(code: str) -> str:
    arms = " ".join(f"WHEN {k} THEN {_text(v)}" for k, v in STATUS_LABELS.items())
    return f"CASE {code} {arms} ELSE {_text(STATUS_LABEL_DEFAULT)} END"


def _norm(text: str) -> str:
    inner = f"trim(lower({text}), {SPACES})"
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("-", " "), (".", ""), (",", "")):
        inner = f"replace({inner}, '{a}', '{b}')"
    return inner


def _strip(text: str) -> str:
    return f"trim(CAST({text} AS VARCHAR), {SPACES})"


# Fingerprint: the values as text, an empty one for NULL, in a list that is written with bars.
HASH = f"sha256(array_to_string([{', '.join(f'ifnull({c}::VARCHAR, ' + repr('') + ')' for c in HASH_COLUMNS)}], '|'))"

CANTON_LIST = "[" + ", ".join(_text(c.upper()) for c in CANTONS) + "]"

REG = f"""reg AS MATERIALIZED (
  SELECT o_custkey AS egid,
    'CH' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS egrid,
    {CANTON_LIST}[CAST(o_custkey % 26 AS INTEGER) + 1] AS gdekt,
    CAST(1 + o_custkey % 2000 AS INTEGER) AS ggdenr,
    'Gemeinde ' || CAST(1 + o_custkey % 2000 AS VARCHAR) AS ggdename,
    o_orderpriority AS strname,
    CAST(1 + o_custkey % 120 AS VARCHAR) AS deinr,
    CASE WHEN o_custkey % 17 <> 0 THEN CAST(1000 + o_custkey % 9000 AS VARCHAR) END AS plz4,
    CASE WHEN o_custkey % 17 <> 0 THEN 'Ort ' || CAST(1000 + o_custkey % 9000 AS VARCHAR) END AS plzname,
    CAST(CASE o_orderstatus WHEN 'O' THEN 1003 WHEN 'F' THEN 1004 WHEN 'P' THEN 1001 ELSE 1006 END AS INTEGER) AS gstat,
    CAST(1010 + 10 * (o_custkey % 5) AS INTEGER) AS gkat,
    CAST(1110 + o_custkey % 10 AS INTEGER) AS gklas,
    CAST(CASE WHEN o_custkey % 11 <> 0 THEN 1850 + o_custkey % 170 END AS INTEGER) AS gbauj,
    CAST(1 + o_custkey % 12 AS INTEGER) AS gbaum,
    CAST(8011 + o_custkey % 13 AS INTEGER) AS gbaup,
    CAST(CASE WHEN o_custkey % 19 = 0 THEN 1990 + o_custkey % 30 END AS INTEGER) AS gabbj,
    CAST(o_custkey % 500 AS DOUBLE) + 0.5 AS garea,
    CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey % 900 AS DOUBLE) * 2 END AS gvol,
    CAST(floor(o_totalprice / 250000) AS INTEGER) AS ganzwhg,
    CAST(o_custkey % 3 AS INTEGER) AS gazzi,
    CASE WHEN o_custkey % 13 <> 0 THEN CAST(o_custkey % 50000 AS DOUBLE) + 2600000.25 END AS gkode,
    CASE WHEN o_custkey % 13 <> 0 THEN CAST(o_custkey % 50000 AS DOUBLE) + 1200000.75 END AS gkodn,
    CAST(o_custkey % 2 AS INTEGER) AS gschutzr,
    '2000-01-01' AS gdatns,
    strftime(o_orderdate, '%Y-%m-%d') AS gdat,
    o_orderkey, o_orderdate, year(o_orderdate) AS y
  FROM orders)"""

LOG = f"""{REG}, log AS (
  SELECT {COLS}, CAST(y + 1 AS VARCHAR) || '-01-01T00:00:00' AS _ingested_at,
    CAST(y + 1 AS VARCHAR) || '-01-01' AS _ingestion_date, CAST(y AS VARCHAR) AS _run_id,
    lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS _batch_id, 'orders' AS _source,
    true AS _is_full_load, y
  FROM reg)"""

STAGED = f"""{LOG}, staged AS MATERIALIZED (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, {HASH} AS record_hash,
      row_number() OVER (PARTITION BY egid, _run_id ORDER BY gdat DESC, _batch_id DESC) AS rn
    FROM log WHERE egid IS NOT NULL) WHERE rn = 1)"""


def _merge(name: str, before: str, staged: str, now: str, scope: str) -> str:
    """CTE of the history after merging ``staged`` into ``before``; ``scope`` limits deletion."""
    differs = f"EXISTS (SELECT 1 FROM {staged} t WHERE t.egid = s.egid AND t.record_hash <> s.record_hash)"
    gone = f"({scope}) AND NOT EXISTS (SELECT 1 FROM {staged} t WHERE t.egid = s.egid)"
    return f"""{name}_flags AS MATERIALIZED (
  SELECT s.*, s.is_current AND {differs} AS closing, s.is_current AND {gone} AS leaving
  FROM {before} s), {name} AS MATERIALIZED (
  SELECT {COLS}, valid_from,
    CASE WHEN closing OR leaving THEN {now} ELSE valid_to END AS valid_to,
    is_current AND NOT closing AND NOT leaving AS is_current, record_hash,
    dqa_deleted OR leaving AS dqa_deleted,
    CASE WHEN closing OR leaving THEN {now} ELSE _silver_loaded END AS _silver_loaded
  FROM {name}_flags
  UNION ALL
  SELECT {COLS}, {now}, {OPEN}, true, record_hash, false, {now}
  FROM {staged} t
  WHERE NOT EXISTS (SELECT 1 FROM {before} s WHERE s.egid = t.egid AND s.is_current)
    OR EXISTS (SELECT 1 FROM {name}_flags f WHERE f.egid = t.egid AND f.closing))"""


EMPTY = f"""h_none AS (
  SELECT {COLS}, TIMESTAMP '2000-01-01' AS valid_from, TIMESTAMP '2000-01-01' AS valid_to,
    false AS is_current, '' AS record_hash, false AS dqa_deleted,
    TIMESTAMP '2000-01-01' AS _silver_loaded FROM log WHERE false)"""


def _chain(runs: list[int], scope: str = "true", last_scope: str | None = None) -> str:
    parts, before = [STAGED, EMPTY], "h_none"
    for run in runs:
        limit = last_scope if last_scope is not None and run == runs[-1] else scope
        parts.append(f"st{run} AS (SELECT * FROM staged WHERE y = {run})")
        parts.append(_merge(f"h{run}", before, f"st{run}", f"TIMESTAMP '{run + 1}-01-01'", limit))
        before = f"h{run}"
    parts.append(f"h AS (SELECT * FROM {before})")
    return ", ".join(parts)


HISTORY = _chain(RUNS)
CURRENT = f"""{HISTORY}, cur AS (
  SELECT egid, egrid, gdekt, ggdenr, ggdename, strname, deinr, plz4, plzname, gstat,
    {_label('gstat')} AS gstat_label, gkat, gklas, gbauj, gbaup, gabbj, garea, gvol, ganzwhg,
    gazzi, gkode, gkodn, gschutzr, gdatns, gdat AS last_mutation_date, valid_from, record_hash,
    _silver_loaded
  FROM h WHERE is_current AND NOT dqa_deleted)"""

RECORDS = """rec AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS egid,
    CASE WHEN o_orderkey % 10 = 0 THEN '9999'
      WHEN o_custkey % 17 <> 0 OR o_orderkey % 2 <> 0 THEN ' ' || CAST(1000 + o_custkey % 9000 AS VARCHAR) || ' ' END AS plz,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL
      WHEN o_orderkey % 2 = 0 THEN replace(lower(o_orderpriority), '-', ' ')
      ELSE o_orderpriority || '.' END AS strasse,
    CAST(CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 1600
      WHEN o_orderkey % 7 = 0 THEN 1851 + o_custkey % 170 ELSE 1850 + o_custkey % 170 END AS INTEGER) AS baujahr,
    CAST(CASE WHEN o_orderkey % 37 <> 0 THEN floor(o_totalprice / 250000) + o_orderkey % 3 END AS INTEGER) AS anzahl_wohnungen,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderstatus = 'O' THEN 'Vermietet'
      WHEN o_orderstatus = 'F' THEN 'leer' ELSE 'unvermietet' END AS nutzungsart
  FROM orders)"""


def _none(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'None')"


def _fill(pattern: str, *values: str) -> str:
    """A message pattern filled with SQL expressions."""
    pieces = pattern.replace("%.1f", "%s").replace("%%", "%").split("%s")
    out = [_text(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        out += [value, _text(piece)]
    return " || ".join(out)


def _result(check: str, arms: list[tuple[str, dict[str, str]]]) -> str:
    """SELECT of one check; the first arm whose condition holds gives all columns."""
    columns = []
    for name in ("check_name", "passed", "severity", "detail", "expected", "actual"):
        cases = " ".join(f"WHEN {cond} THEN {values.get(name, 'NULL')}" for cond, values in arms)
        kind = "BOOLEAN" if name == "passed" else "VARCHAR"
        columns.append(f"CAST(CASE {cases} END AS {kind}) AS {name}")
    return f"SELECT {_text(check)} AS check_id, {', '.join(columns)}, egid FROM pair"


def _skip(name: str, detail: str = K.SKIPPED_TEXT) -> dict[str, str]:
    return {
        "check_name": _text(name), "passed": "true", "severity": _text(K.INFO), "detail": _text(detail)
    }


def _judged(name: str, ok: str, severity: str, detail: str, expected: str, actual: str) -> dict[str, str]:
    return {
        "check_name": _text(name), "passed": f"({ok})", "severity": _text(severity),
        "detail": f"CASE WHEN {ok} THEN '' ELSE {detail} END",
        "expected": f"CAST({expected} AS VARCHAR)", "actual": f"CAST({actual} AS VARCHAR)",
    }


_IN_RANGE = "baujahr BETWEEN 1700 AND 2001"
_ADDRESS_OK = (
    f"({_strip('plz')} IS NOT DISTINCT FROM {_strip('plz4')}) AND "
    f"({_norm('strasse')} IS NOT DISTINCT FROM {_norm('strname')})"
)
_STATUS_OK = (
    f"NOT (coalesce(gstat IN ({', '.join(map(str, UNFINISHED_STATES))}), false) AND "
    "coalesce(contains(lower(nutzungsart), 'vermietet'), false))"
)
_PCT = "(abs(anzahl_wohnungen - ganzwhg) / CAST(greatest(ganzwhg, 1) AS DOUBLE) * 100)"
CHECK_SQL = {
    "key_exists": _result(
        K.EXISTS_ID,
        [("true", _judged(
            K.EXISTS_NAME, "found", K.CRITICAL, _fill(K.NOT_FOUND_TEXT, _none("egid")),
            _text(K.PRESENT), f"CASE WHEN found THEN {_text(K.PRESENT)} ELSE {_text(K.ABSENT)} END"))],
    ),
    "address_matches": _result(
        K.ADDRESS_ID,
        [("NOT found", _skip(K.ADDRESS_SHORT)),
         ("true", _judged(
             K.ADDRESS_NAME, _ADDRESS_OK, K.WARNING,
             _fill(K.ADDRESS_TEXT, *map(_none, ("plz", "plz4", "strasse", "strname"))),
             f"{_none('plz4')} || ' ' || {_none('strname')}",
             f"{_none('plz')} || ' ' || {_none('strasse')}"))],
    ),
    "year_plausible": _result(
        K.YEAR_ID,
        [("baujahr IS NULL", {
            "check_name": _text(K.YEAR_SHORT), "passed": "false", "severity": _text(K.WARNING),
            "detail": _text(K.NO_YEAR_TEXT)}),
         ("true", _judged(
             K.YEAR_NAME, f"{_IN_RANGE} AND (gbauj IS NULL OR gbauj = baujahr)", K.WARNING,
             f"CASE WHEN NOT ({_IN_RANGE}) THEN "
             f"{_fill(K.YEAR_RANGE_TEXT, _none('baujahr'), _text('1700'), _text('2001'))} ELSE "
             f"{_fill(K.YEAR_DIFFERS_TEXT, _none('baujahr'), _none('gbauj'))} END",
             "gbauj", "baujahr"))],
    ),
    "status_fits_use": _result(
        K.STATUS_ID,
        [("NOT found", _skip(K.STATUS_SHORT)),
         ("true", _judged(
             K.STATUS_NAME, _STATUS_OK, K.CRITICAL,
             _fill(K.STATUS_TEXT, _none("gstat"), "gstat_label", _none("nutzungsart")),
             _text(K.STATUS_EXPECTED), f"'gstat=' || {_none('gstat')}"))],
    ),
    "dwellings_agree": _result(
        K.DWELLINGS_ID,
        [("NOT found", _skip(K.DWELLINGS_SHORT)),
         ("anzahl_wohnungen IS NULL OR ganzwhg IS NULL", _skip(K.DWELLINGS_SHORT, K.NO_DWELLINGS_TEXT)),
         ("true", _judged(
             K.DWELLINGS_NAME, f"{_PCT} <= 10", K.WARNING,
             _fill(K.DWELLINGS_TEXT, _none("anzahl_wohnungen"), _none("ganzwhg"), f"format('{{:.1f}}', {_PCT})"),
             "ganzwhg", "anzahl_wohnungen"))],
    ),
}


def _checks(current: str = CURRENT, source: str = "cur") -> str:
    union = " UNION ALL ".join(f"({s})" for s in CHECK_SQL.values())
    return f"""{current}, {RECORDS}, pair AS MATERIALIZED (
  SELECT rec.*, c.egid IS NOT NULL AS found, c.plz4, c.strname, c.gbauj, c.gstat, c.gstat_label, c.ganzwhg
  FROM rec LEFT JOIN {source} c ON c.egid = nullif(rec.egid, 0)),
res AS (SELECT *, '2002-01-01T08:30:00' AS checked_at FROM ({union}))"""


CHECKS = _checks()
RESULT_COLUMNS = "check_id, check_name, egid, passed, severity, detail, expected, actual, checked_at"
TOTALS = """SELECT 'orders' AS source_system, 'run00001' AS run_id, count(*) AS total_checks,
  count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  count(*) FILTER (NOT passed AND severity = 'critical') AS critical_fails,
  round(count(*) FILTER (passed) / CAST(count(*) AS DOUBLE) * 100, 1) AS pass_rate,
  '2002-01-01T08:30:00' AS started_at FROM res"""
BY_CHECK = """SELECT '[' || check_id || '] ' || check_name AS "check",
  count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
  CASE max(CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END)
    WHEN 3 THEN 'critical' WHEN 2 THEN 'warning' ELSE 'info' END AS severity
  FROM res GROUP BY 1"""

# ---- scans, sources, sinks ------------------------------------------------------------------

_ANSWERED = "o_orderkey % 20 <> 0 AND o_orderkey % 21 <> 0 AND o_orderkey % 22 <> 0"
_STREET = "CASE WHEN o_orderkey % 3 = 0 THEN 'Rue ' || strname ELSE strname END"
_DWELLINGS = "ganzwhg + 1 + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END"

ORACLE["registry_xml"] = f"""WITH {REG} SELECT o_orderkey AS requested, o_orderkey AS egid, egrid, gdekt,
  ggdenr, ggdename, {_STREET} AS strname, deinr, plz4, plzname, gstat, gkat, gklas, gbauj, gbaup, garea,
  CAST({_DWELLINGS} AS INTEGER) AS ganzwhg, gkode, gkodn, gdatns, gdat FROM reg WHERE {_ANSWERED}"""
ORACLE["xml_dwelling_count"] = f"""WITH {REG} SELECT o_orderkey AS requested,
  CAST({_DWELLINGS} AS INTEGER) AS dwellings FROM reg WHERE {_ANSWERED}"""
ORACLE["xml_street_language"] = f"""SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'other' ELSE 'german' END AS language,
  count(*) AS streets FROM orders WHERE {_ANSWERED} GROUP BY 1"""
_RANGE = f"""{REG}, hit AS (SELECT * FROM reg WHERE {_ANSWERED}), keys AS (
  SELECT unnest(generate_series((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) FROM orders))) AS k),
rng AS (SELECT k AS egid, hit.gdekt, hit.gstat, hit.egid IS NULL AS _not_found
  FROM keys LEFT JOIN hit ON hit.o_orderkey = k)"""
ORACLE["key_range_lookup"] = f"WITH {_RANGE} SELECT * FROM rng"
ORACLE["key_range_counts"] = f"""WITH {_RANGE} SELECT count(*) FILTER (NOT _not_found) AS found,
  count(*) FILTER (_not_found) AS missing FROM rng"""

_EXTRACT = f"""{REG}, ext AS (SELECT {COLS.replace(' gbauj,', ' CASE WHEN o_orderkey % 23 <> 0 THEN gbauj END AS gbauj,')},
  o_orderkey FROM reg WHERE o_orderkey % 101 <> 0 AND egid <> 0)"""
ORACLE["tsv_extract"] = f"WITH {_EXTRACT} SELECT {COLS} FROM ext"
ORACLE["tsv_cantons"] = f"""WITH {_EXTRACT} SELECT gdekt, count(*) AS records, count(gbauj) AS with_year,
  count(gvol) AS with_volume FROM ext WHERE gdekt IN ('ZH', 'BE', 'AG') GROUP BY 1"""
_BULK = COLS
for _c in ("strname", "deinr", "plz4", "plzname", "gdatns"):
    _BULK = _BULK.replace(f" {_c},", f" CAST(NULL AS VARCHAR) AS {_c},")
ORACLE["bulk_load_once"] = f"""WITH {_EXTRACT} SELECT {_BULK}, 'first' AS _run_id, 'first_bulk' AS _batch_id,
  'gwr_zip' AS _source, false AS _is_full_load FROM ext"""
ORACLE["records_csv"] = f"""WITH {RECORDS} SELECT egid, plz, strasse, baujahr, anzahl_wohnungen, nutzungsart FROM rec"""
ORACLE["table_scan"] = "SELECT * FROM orders"
ORACLE["bronze_append"] = f"""WITH {LOG} SELECT _run_id, _ingestion_date, _is_full_load, count(*) AS records,
  count(DISTINCT egid) AS buildings, max(CAST(gdat AS DATE)) AS max_gdat, count(plz4) AS with_postcode FROM log GROUP BY ALL"""
ORACLE["bronze_schema_merge"] = f"""WITH {LOG} SELECT egid, _run_id, _batch_id,
  CASE WHEN _run_id >= '1998' THEN gkat + 1 END AS gwaerzh1 FROM log"""
ORACLE["table_write"] = """SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1
  UNION ALL SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1"""
ORACLE["staging"] = f"""WITH {LOG} SELECT {COLS}, _run_id, _batch_id, record_hash FROM (
  SELECT *, {HASH} AS record_hash, row_number() OVER (PARTITION BY egid ORDER BY gdat DESC, _batch_id DESC) AS rn
  FROM log WHERE egid IS NOT NULL) WHERE rn = 1"""
ORACLE["published_views"] = f"""WITH {HISTORY}
  SELECT 'gold_gwr_current' AS "view", count(*) FILTER (is_current AND NOT dqa_deleted) AS n FROM h
  UNION ALL SELECT 'gold_gwr_history', count(*) FROM h
  UNION ALL SELECT 'gold_gwr_changes', count(*) FROM (SELECT egid FROM h GROUP BY egid HAVING count(*) > 1)"""
ORACLE["watermark_log"] = f"""WITH {LOG}, marks AS (
  SELECT y, CAST(CAST(max(gdat) AS DATE) - 1 AS DATE) AS d FROM log GROUP BY y),
tries AS (SELECT y, 1 AS n, d FROM marks UNION ALL SELECT y, 2, DATE '1999-06-30' FROM marks),
sofar AS (SELECT *, coalesce(max(d) OVER (ORDER BY y, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  DATE '2000-01-01') AS before FROM tries)
SELECT 'gwr_buildings' AS source, d AS watermark_date, make_timestamp(y + 1, 1, 1, 0, 0, 0) AS recorded_at
FROM sofar WHERE d > greatest(before, DATE '2000-01-01')"""
ORACLE["report_json"] = f"WITH {CHECKS} {TOTALS}"
ORACLE["dry_run"] = "SELECT count(*) AS records, false AS written FROM orders"

# ---- scalar functions -----------------------------------------------------------------------

ORACLE["safe_numbers"] = """SELECT event_id,
  TRY_CAST(regexp_extract(props, ': (.*)\\}', 1) AS INTEGER) AS as_int, value AS as_double,
  CAST(NULL AS INTEGER) AS bad_int, CAST(NULL AS DOUBLE) AS bad_double FROM events"""
ORACLE["strict_casts"] = """SELECT l_orderkey AS "key", l_linenumber AS line, l_discount AS discount,
  l_tax > 0 AS taxed FROM lineitem"""
ORACLE["lineage"] = """SELECT '2002-01-01T08:30:00' AS _ingested_at, '2002-01-01' AS _ingestion_date,
  '0a1b2c3d' AS _run_id, 'gwr_api' AS _source, false AS _is_full_load, count(*) AS records,
  true AS batches_fit, true AS batches_named FROM events"""
ORACLE["row_fingerprint"] = f"WITH {LOG} SELECT _batch_id, {HASH} AS record_hash FROM log"
ORACLE["status_labels"] = f"""WITH {LOG}, coded AS (
  SELECT CASE WHEN egid % 29 = 0 THEN 8 WHEN egid % 31 = 0 THEN 4 ELSE gstat END AS code FROM log)
SELECT code, count(*) AS n, {_label('code')} AS label FROM coded GROUP BY code"""
ORACLE["normalised_text"] = f"SELECT doc_id, {_norm('text')} AS text FROM documents"
ORACLE["code_match"] = f"""SELECT c_custkey, {_strip('c_nationkey')} =
  {_strip("' ' || CAST(c_custkey % 25 AS VARCHAR) || chr(9)")} AS same FROM customer"""
ORACLE["text_contains"] = """SELECT lang, coalesce(contains(lower(text), 'the'), false) AS hit,
  count(*) AS documents FROM documents GROUP BY ALL"""
ORACLE["percent_difference"] = """SELECT l_orderkey, l_linenumber, l_quantity,
  round(abs(CAST(floor(l_quantity) AS BIGINT) - (l_linenumber - 1))
    / CAST(greatest(l_linenumber - 1, 1) AS DOUBLE) * 100, 6) AS difference FROM lineitem"""
ORACLE["date_steps"] = f"""WITH {LOG} SELECT _batch_id,
  CASE WHEN egid % 10 <> 0 THEN CAST(y AS INTEGER) END AS mutation_year,
  CASE WHEN egid % 10 <> 0 THEN strftime(CAST(gdat AS DATE) - 1, '%Y-%m-%d') END AS day_before FROM log"""

# ---- latest row, history --------------------------------------------------------------------

ORACLE["latest_order"] = """SELECT * EXCLUDE (rn) FROM (SELECT *,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_custkey IS NOT NULL) WHERE rn = 1"""
ORACLE["staged_by_run"] = f"WITH {STAGED} SELECT egid, _run_id, _batch_id, record_hash FROM staged"
ORACLE["history_replay"] = f"WITH {HISTORY} SELECT {VERSION} FROM h"
ORACLE["history_replay_keep"] = f"WITH {_chain(RUNS, 'false')} SELECT {VERSION} FROM h"
ORACLE["history_merge"] = ORACLE["history_replay"]
ORACLE["merge_stats"] = f"""WITH {HISTORY}, times AS (
  SELECT valid_from AS "at" FROM h UNION SELECT valid_to FROM h WHERE NOT is_current)
SELECT t."at", (SELECT count(*) FROM h WHERE NOT is_current AND NOT dqa_deleted AND valid_to = t."at") AS records_closed,
  (SELECT count(*) FROM h WHERE valid_from = t."at") AS records_inserted,
  (SELECT count(*) FROM h WHERE NOT is_current AND dqa_deleted AND valid_to = t."at") AS records_deleted
FROM times t"""
_LAST, _PREVIOUS = RUNS[-1], f"h{RUNS[-2]}"
_ACTIONS = f"""{HISTORY}, act AS (SELECT coalesce(s.egid, t.egid) AS egid,
  CASE WHEN s.egid IS NULL THEN 'new' WHEN t.egid IS NULL THEN 'deleted'
    WHEN s.record_hash = t.record_hash THEN 'unchanged' ELSE 'changed' END AS action
  FROM (SELECT * FROM {_PREVIOUS} WHERE is_current) s FULL JOIN st{_LAST} t ON s.egid = t.egid)"""
ORACLE["classify_keys"] = f"WITH {_ACTIONS} SELECT egid, action FROM act"
ORACLE["merge_last_run"] = ORACLE["history_replay"]
ORACLE["merge_last_small"] = f"WITH {_chain(RUNS, last_scope='false')} SELECT {VERSION} FROM h"
ORACLE["merge_last_counts"] = f"""WITH {HISTORY} SELECT
  count(*) FILTER (NOT is_current AND NOT dqa_deleted AND valid_to = TIMESTAMP '{_LAST + 1}-01-01') AS records_closed,
  count(*) FILTER (valid_from = TIMESTAMP '{_LAST + 1}-01-01') AS records_inserted,
  count(*) FILTER (NOT is_current AND dqa_deleted AND valid_to = TIMESTAMP '{_LAST + 1}-01-01') AS records_deleted FROM h"""
_THREE = "s.gdekt IN ('ZH', 'BE', 'AG')"
ORACLE["merge_some_cantons"] = f"WITH {_chain(RUNS, last_scope=_THREE)} SELECT {VERSION} FROM h"
ORACLE["vanished_keys"] = f"WITH {_ACTIONS} SELECT egid FROM act WHERE action = 'deleted'"
ORACLE["reappeared_keys"] = f"""WITH {HISTORY} SELECT egid, count(*) FILTER (dqa_deleted) AS deletions,
  count(*) FILTER (is_current) AS now_current FROM h GROUP BY egid
  HAVING count(*) FILTER (dqa_deleted) > 0 AND count(*) FILTER (is_current) > 0"""
ORACLE["history_rules"] = f"""WITH {HISTORY}, numbered AS (SELECT *, row_number() OVER () AS id FROM h)
SELECT count(DISTINCT a.egid) AS broken FROM numbered a
WHERE a.valid_from >= a.valid_to OR a.is_current <> (a.valid_to = {OPEN})
  OR EXISTS (SELECT 1 FROM numbered b WHERE b.egid = a.egid AND b.id <> a.id
    AND ((a.is_current AND b.is_current) OR (a.valid_from < b.valid_to AND b.valid_from < a.valid_to)))"""
ORACLE["point_in_time"] = f"""WITH {HISTORY} SELECT {VERSION} FROM h
  WHERE valid_from <= TIMESTAMP '1998-06-30 12:00:00' AND TIMESTAMP '1998-06-30 12:00:00' < valid_to"""

# ---- views ----------------------------------------------------------------------------------

ORACLE["current_buildings"] = f"WITH {CURRENT} SELECT * FROM cur"
ORACLE["building_history"] = f"""WITH {HISTORY} SELECT egid, egrid, gdekt, ggdenr, ggdename, strname, deinr, plz4,
  plzname, gstat, gkat, gklas, gbauj, gabbj, garea, gvol, ganzwhg, valid_from, valid_to, is_current,
  dqa_deleted, record_hash, CAST(date_diff('day', valid_from, valid_to) AS INTEGER) AS days_valid,
  CAST(date_diff('day', valid_from, least(valid_to, TIMESTAMP '2001-12-31')) AS INTEGER) AS days_open
  FROM h ORDER BY egid, valid_from"""
ORACLE["changed_buildings"] = f"""WITH {HISTORY} SELECT egid, count(*) AS version_count,
  min(valid_from) AS first_seen, max(valid_from) AS last_change, max(gstat) AS latest_gstat,
  min(gstat) AS initial_gstat, arg_max(gstat, valid_from) AS last_gstat, arg_min(gstat, valid_from) AS first_gstat,
  string_agg(CAST(gstat AS VARCHAR), ',' ORDER BY valid_from) AS gstat_history
  FROM h GROUP BY egid HAVING count(*) > 1"""
ORACLE["most_changed_history"] = f"""WITH {HISTORY} SELECT egid, gstat, ganzwhg, valid_from, valid_to, is_current,
  dqa_deleted FROM h WHERE egid = (SELECT egid FROM h GROUP BY egid HAVING count(*) > 1
    ORDER BY count(*) DESC, egid LIMIT 1) ORDER BY valid_from"""
_SUMMARY = """SELECT count(*) AS total_buildings, count(DISTINCT gdekt) AS kantone,
  count(DISTINCT ggdenr) AS gemeinden,
  CAST(sum(CASE WHEN gstat = 1004 THEN 1 ELSE 0 END) AS BIGINT) AS bestehende,
  CAST(sum(CASE WHEN gstat = 1003 THEN 1 ELSE 0 END) AS BIGINT) AS im_bau,
  CAST(sum(CASE WHEN gstat = 1001 THEN 1 ELSE 0 END) AS BIGINT) AS geplant,
  min(last_mutation_date) AS oldest_mutation, max(last_mutation_date) AS latest_mutation FROM cur"""
ORACLE["stock_summary"] = f"WITH {CURRENT} {_SUMMARY}"

# ---- profiling ------------------------------------------------------------------------------

ORACLE["run_records"] = """SELECT strftime(ts, '%Y%m%d') AS _run_id, strftime(ts, '%Y-%m-%d') AS _ingestion_date,
  false AS _is_full_load, count(*) AS records FROM events GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 10"""
ORACLE["newest_run_cantons"] = """SELECT event_type AS gdekt, count(*) AS "count" FROM events
  WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30"""
ORACLE["version_totals"] = f"""WITH {HISTORY} SELECT count(*) AS total, count(*) FILTER (is_current) AS "current",
  count(*) FILTER (NOT is_current) AS historic, count(*) FILTER (dqa_deleted) AS deleted FROM h"""
ORACLE["versions_per_building"] = f"WITH {HISTORY} SELECT egid, count(*) AS versionen FROM h GROUP BY 1 HAVING count(*) > 1"
ORACLE["status_distribution"] = f"""WITH {CURRENT} SELECT gstat, gstat_label, count(*) AS "count" FROM cur GROUP BY ALL"""
ORACLE["canton_overview"] = f"""WITH {CURRENT} SELECT gdekt, count(*) AS gebaeude,
  CAST(sum(ganzwhg) AS BIGINT) AS wohnungen, round(avg(gbauj), 6) AS durchschnitt_baujahr FROM cur GROUP BY 1"""
ORACLE["buildings_by_mutation_year"] = f"""WITH {CURRENT} SELECT CAST(substr(last_mutation_date, 1, 4) AS INTEGER) AS mutation_jahr,
  count(*) AS "count" FROM cur GROUP BY 1"""
_PREV = f"""{HISTORY}, prev AS (SELECT egid, valid_from,
  lag(gstat) OVER (PARTITION BY egid ORDER BY valid_from) AS prev_gstat, gstat FROM h)"""
ORACLE["previous_status"] = f"WITH {_PREV} SELECT * FROM prev WHERE prev_gstat IS NOT NULL"
_TRANSITIONS = "SELECT prev_gstat, gstat, count(*) AS anzahl FROM prev WHERE prev_gstat IS NOT NULL GROUP BY ALL"
ORACLE["status_transitions"] = f"WITH {_PREV} {_TRANSITIONS}"
ORACLE["gap_profile"] = f"""WITH {CURRENT} SELECT count(*) FILTER (gkode IS NULL OR gkodn IS NULL) AS ohne_koordinaten,
  count(*) FILTER (ganzwhg > 0 AND gbauj IS NULL) AS ohne_baujahr, count(*) FILTER (plz4 IS NULL) AS ohne_plz FROM cur"""
ORACLE["label_gaps"] = """SELECT count(*) FILTER (quality IS NULL OR toxic IS NULL) AS no_label,
  count(*) FILTER (n_chars > 1000 AND quality IS NULL) AS long_without_label,
  count(*) FILTER (n_chars IS NULL) AS no_length FROM documents LEFT JOIN labels USING (doc_id)"""

# ---- quality checks -------------------------------------------------------------------------

ORACLE["check_results"] = f"WITH {CHECKS} SELECT {RESULT_COLUMNS} FROM res"
ORACLE["check_results_salted"] = ORACLE["check_results"]
_IDS = {
    "key_exists": K.EXISTS_ID, "address_matches": K.ADDRESS_ID, "year_plausible": K.YEAR_ID,
    "status_fits_use": K.STATUS_ID, "dwellings_agree": K.DWELLINGS_ID,
}
for _name, _id in _IDS.items():
    ORACLE[f"check_{_name}"] = f"""WITH {CHECKS} SELECT check_id, check_name, egid,
  CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status, severity, detail, expected, actual
  FROM res WHERE check_id = '{_id}'"""
ORACLE["record_lookup"] = f"""WITH {CURRENT}, {RECORDS} SELECT o_orderkey, rec.egid, c.egid AS ref_egid, c.gstat, c.plz4
  FROM rec LEFT JOIN cur c ON c.egid = rec.egid"""
ORACLE["record_lookup_reduced"] = ORACLE["record_lookup"]
ORACLE["check_report"] = f"WITH {CHECKS} {TOTALS}"
ORACLE["check_report_by_name"] = f"WITH {CHECKS} {BY_CHECK}"

# ---- watermark ------------------------------------------------------------------------------

ORACLE["watermark_now"] = f"""WITH {LOG} SELECT CAST(max(gdat) AS DATE) AS watermark_date, 'ZH' AS source FROM log WHERE gdekt = 'ZH'
  UNION ALL SELECT DATE '2000-01-01', 'XX'"""
ORACLE["watermark_advance"] = f"""WITH {LOG} SELECT 'ZH' AS source,
  make_date(year(max(CAST(gdat AS DATE))) + 1, 1, 1) AS watermark_date, TIMESTAMP '2002-01-01 08:30:00' AS recorded_at
  FROM log WHERE gdekt = 'ZH'"""
ORACLE["watermark_safe"] = f"""WITH {LOG} SELECT CAST(CAST(max(gdat) AS DATE) - 1 AS DATE) AS watermark_date, 'dated' AS input FROM log
  UNION ALL SELECT DATE '1999-09-09', 'bad' UNION ALL SELECT DATE '1999-09-09', 'none'"""
ORACLE["run_max_mutation"] = f"WITH {LOG} SELECT max(gdat) AS max_gdat FROM log WHERE y = 1997"
ORACLE["changed_rows"] = f"""WITH {LOG} SELECT egid, gdekt, gdat, _batch_id FROM log
  WHERE gdat > '1999-12-31' AND gdekt IN ('ZH', 'BE')"""
ORACLE["full_load_rows"] = "SELECT CAST(year(o_orderdate) AS VARCHAR) AS _run_id, count(*) AS records FROM orders GROUP BY 1"

# ---- jobs -----------------------------------------------------------------------------------

_STATE_ORDER = ", ".join(["gdat DESC NULLS LAST", *[f"{c} DESC NULLS LAST" for c in HASH_COLUMNS]])
_NEWEST = f"row_number() OVER (PARTITION BY egid ORDER BY {_STATE_ORDER})"
_SINCE = "(SELECT greatest(strftime(max(CAST(gdat AS DATE)) - 1, '%Y-%m-%d'), '2000-01-01') FROM log WHERE gdat < '2000-07-01')"


def _newest(name: str, source: str, condition: str) -> str:
    """CTE of the newest state of each building among the rows of a load."""
    return f"""{name} AS MATERIALIZED (SELECT * EXCLUDE (rn), {HASH} AS record_hash FROM (
  SELECT *, {_NEWEST} AS rn FROM {source} WHERE egid IS NOT NULL AND ({condition})) WHERE rn = 1)"""


_LATER = f"(gdat > {_SINCE} OR gdat IS NULL)"
_REFRESH = f"""{LOG}, {EMPTY}, {_newest('one', 'log', "gdat < '2000-07-01'")}, {_newest('two', 'log', _LATER)},
{_merge('hone', 'h_none', 'one', "TIMESTAMP '2000-07-01'", 'true')},
{_merge('h', 'hone', 'two', "TIMESTAMP '2001-09-01'", 'false')}"""
_REFRESH_CURRENT = f"""{_REFRESH}, cur AS (SELECT *, gdat AS last_mutation_date, {_label('gstat')} AS gstat_label
  FROM h WHERE is_current AND NOT dqa_deleted)"""
ORACLE["refresh_job"] = f"WITH {_REFRESH} SELECT {VERSION} FROM h"


def _merged(history: str, moment: str) -> str:
    return f"""(SELECT count(*) FROM {history} WHERE NOT is_current AND valid_to = {moment} AND NOT dqa_deleted) AS records_closed,
  (SELECT count(*) FROM {history} WHERE valid_from = {moment}) AS records_inserted,
  (SELECT count(*) FROM {history} WHERE NOT is_current AND valid_to = {moment} AND dqa_deleted) AS records_deleted"""


ORACLE["refresh_stats"] = f"""WITH {_REFRESH}
SELECT '00000001' AS run_id, CAST(NULL AS VARCHAR) AS since_date, (SELECT count(*) FROM log WHERE gdat < '2000-07-01') AS total_written,
  true AS has_batches, {_merged('hone', "TIMESTAMP '2000-07-01'")}
UNION ALL SELECT '00000002', {_SINCE}, (SELECT count(*) FROM log WHERE {_LATER}), true, {_merged('h', "TIMESTAMP '2001-09-01'")}"""
ORACLE["status_job"] = f"WITH {_REFRESH_CURRENT} {_SUMMARY}"
ORACLE["explore_job"] = f"""WITH {_REFRESH_CURRENT}, prev AS (SELECT egid, valid_from,
  lag(gstat) OVER (PARTITION BY egid ORDER BY valid_from) AS prev_gstat, gstat FROM h)
SELECT 'runs' AS report, '00000001' AS key, (SELECT count(*) FROM log WHERE gdat < '2000-07-01') AS value
UNION ALL SELECT 'runs', '00000002', (SELECT count(*) FROM log WHERE {_LATER})
UNION ALL SELECT 'latest_run', gdekt, count(*) FROM log WHERE {_LATER} GROUP BY ALL
UNION ALL SELECT 'versions', CAST(egid AS VARCHAR), count(*) FROM h GROUP BY egid HAVING count(*) > 1
UNION ALL SELECT 'status', CAST(gstat AS VARCHAR), count(*) FROM cur GROUP BY gstat
UNION ALL SELECT 'cantons', gdekt, count(*) FROM cur GROUP BY gdekt
UNION ALL SELECT 'mutation_years', substr(gdat, 1, 4), count(*) FROM cur GROUP BY ALL
UNION ALL SELECT 'transitions', prev_gstat || '>' || gstat, count(*) FROM prev WHERE prev_gstat IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'row_counts', 'total', count(*) FROM h
UNION ALL SELECT 'row_counts', 'current', count(*) FROM h WHERE is_current
UNION ALL SELECT 'row_counts', 'historic', count(*) FROM h WHERE NOT is_current
UNION ALL SELECT 'row_counts', 'deleted', count(*) FROM h WHERE dqa_deleted
UNION ALL SELECT 'gaps', 'ohne_koordinaten', count(*) FROM cur WHERE gkode IS NULL OR gkodn IS NULL
UNION ALL SELECT 'gaps', 'ohne_baujahr', count(*) FROM cur WHERE ganzwhg > 0 AND gbauj IS NULL
UNION ALL SELECT 'gaps', 'ohne_plz', count(*) FROM cur WHERE plz4 IS NULL"""
ORACLE["dqa_job"] = f"WITH {_checks(_REFRESH_CURRENT)} {BY_CHECK}"

# The mark after the first load stays where it is while one canton is loaded.
ORACLE["watermark_cantons"] = f"""WITH {LOG} SELECT egid, gdekt, gdat, '00000002' AS _run_id FROM log
  WHERE gdat > {_SINCE} AND gdekt = 'ZH'
  UNION ALL SELECT egid, gdekt, gdat, '00000003' FROM log WHERE gdat > {_SINCE}"""
# The same loads with a mark per canton; a canton goes by the common mark until it has its own.
ORACLE["watermark_per_canton"] = f"""WITH {LOG}, own AS (
  SELECT gdekt, max(CAST(gdat AS DATE)) - 1 AS m FROM log WHERE gdat < '2000-07-01' GROUP BY gdekt),
first AS (SELECT c.gdekt, coalesce(strftime(own.m, '%Y-%m-%d'), {_SINCE}) AS m
  FROM (SELECT DISTINCT gdekt FROM log) c LEFT JOIN own ON own.gdekt = c.gdekt AND own.m > DATE '2000-01-01'),
two AS (SELECT log.* FROM log JOIN first f ON f.gdekt = log.gdekt WHERE log.gdekt = 'ZH' AND gdat > f.m),
later AS (SELECT greatest((SELECT m FROM first WHERE gdekt = 'ZH'), coalesce(strftime(max(CAST(gdat AS DATE)) - 1, '%Y-%m-%d'), '')) AS m FROM two)
SELECT egid, gdekt, gdat, '00000002' AS _run_id FROM two
  UNION ALL SELECT egid, gdekt, gdat, '00000003' FROM log WHERE gdekt = 'ZH' AND gdat > (SELECT m FROM later)
  UNION ALL SELECT egid, log.gdekt, gdat, '00000004' FROM log JOIN first f ON f.gdekt = log.gdekt
  WHERE gdat > CASE WHEN log.gdekt = 'ZH' THEN (SELECT m FROM later) ELSE f.m END"""
ORACLE["increment_without_date"] = f"""WITH {LOG} SELECT egid, gstat, CASE WHEN egid % 5 <> 0 THEN gdat END AS gdat FROM log
  WHERE egid % 5 = 0 OR gdat > (SELECT greatest(strftime(max(CAST(gdat AS DATE)) - 1, '%Y-%m-%d'), '2000-01-01')
    FROM log WHERE gdat < '2000-07-01' AND egid % 5 <> 0)"""

_XML_LACKS = [c for c in REGISTRY_COLUMNS if c in ("gbaum", "gabbj", "gvol", "gazzi", "gschutzr")]
_XML_HAS = [c for c in REGISTRY_COLUMNS if c not in _XML_LACKS]
_FROM_XML = ", ".join(
    f"h1.{c}" if c in _XML_LACKS else f"a.{c}" for c in REGISTRY_COLUMNS
)
ORACLE["refresh_two_sources"] = f"""WITH {LOG}, {EMPTY}, {_newest('one', 'log', 'true')},
{_merge('hone', 'h_none', 'one', "TIMESTAMP '2001-09-01'", 'true')},
answers AS (SELECT o_orderkey AS egid, egrid, gdekt, ggdenr, ggdename, {_STREET} AS strname, deinr, plz4, plzname, gstat,
  gkat, gklas, gbauj, gbaup, garea, CAST({_DWELLINGS} AS INTEGER) AS ganzwhg, gkode, gkodn, gdatns, gdat
  FROM reg WHERE {_ANSWERED} AND gdat > '2000-01-01'),
completed AS (SELECT {_FROM_XML} FROM answers a LEFT JOIN (SELECT * FROM hone WHERE is_current) h1 ON h1.egid = a.egid),
{_newest('two', 'completed', 'true')},
{_merge('h', 'hone', 'two', "TIMESTAMP '2001-10-01'", 'false')}
SELECT {VERSION}, {", ".join(_XML_LACKS)} FROM h"""

_MIXED_SINCE = "(SELECT greatest(strftime(max(CAST(gdat AS DATE)) - 1, '%Y-%m-%d'), '2000-01-01') FROM log WHERE gdat < '1998-01-01')"
ORACLE["rebuild_mixed_log"] = f"""WITH {LOG}, {EMPTY}, {_newest('one', 'log', "gdat < '1998-01-01'")},
{_newest('two', 'log', "gdat >= '1998-01-01' AND gdat < '1999-06-01' AND gdekt IN ('ZH', 'BE')")},
{_newest('three', 'log', f"gdat > {_MIXED_SINCE}")},
{_merge('hone', 'h_none', 'one', "TIMESTAMP '1998-01-01'", 'true')},
{_merge('htwo', 'hone', 'two', "TIMESTAMP '1999-06-01'", "s.gdekt IN ('ZH', 'BE')")},
{_merge('h', 'htwo', 'three', "TIMESTAMP '2001-09-01'", 'false')}
SELECT {VERSION} FROM h"""

_BULK_LOG = f"{_EXTRACT}, log AS (SELECT {_BULK} FROM ext WHERE gdekt = 'AG')"
ORACLE["bulk_second_file"] = f"""WITH {_BULK_LOG}, {EMPTY}, {_newest('one', 'log', "gdat < '1998-07-01'")},
{_newest('two', 'log', "gdat >= '1998-07-01'")},
{_merge('hone', 'h_none', 'one', "TIMESTAMP '2001-07-01'", 'false')},
{_merge('h', 'hone', 'two', "TIMESTAMP '2001-09-01'", 'false')}
SELECT egid, gstat, ganzwhg, is_current, dqa_deleted FROM h"""
ORACLE["bulk_job"] = f"""WITH {_EXTRACT} SELECT '00000007' AS run_id, 'ZH' AS kanton,
  (SELECT count(*) FROM ext WHERE gdekt = 'ZH') AS records
  UNION ALL SELECT '00000008', 'ZH', 0"""
# Each canton's rows appear when its run was merged: the crash delays that, but loses nothing.
ORACLE["bulk_after_crash"] = f"""WITH {_EXTRACT}, log AS (SELECT {_BULK} FROM ext WHERE gdekt IN ('AG', 'BE', 'ZH', 'VD')),
{_newest('one', 'log', 'true')}
SELECT egid, gdekt, gstat, ganzwhg, CASE gdekt WHEN 'AG' THEN TIMESTAMP '2002-01-02' WHEN 'BE' THEN TIMESTAMP '2002-02-01 12:00:00'
  WHEN 'ZH' THEN TIMESTAMP '2002-03-02' ELSE TIMESTAMP '2002-04-01' END AS valid_from,
  true AS is_current, false AS dqa_deleted FROM one"""
ORACLE["tsv_damaged_part"] = f"""WITH {_EXTRACT}, log AS (SELECT {COLS} FROM ext WHERE gdekt IN ('ZH', 'BE', 'AG')), {EMPTY},
{_newest('one', 'log', "gdat < '1998-07-01'")}, {_newest('two', 'log', "gdat >= '1998-07-01' AND gdekt <> 'BE'")},
{_merge('hone', 'h_none', 'one', "TIMESTAMP '2001-07-02'", 'true')},
{_merge('h', 'hone', 'two', "TIMESTAMP '2001-08-02'", "s.gdekt IN ('ZH', 'AG')")}
SELECT gdekt, is_current, dqa_deleted, count(*) AS versions, max(valid_to) AS valid_to, 1 AS skipped, '00000008' AS skipped_in
FROM h GROUP BY ALL"""
_NEW_MARK = "SELECT strftime(max(CAST(gdat AS DATE)) - 1, '%Y-%m-%d')"
ORACLE["extract_job"] = f"""WITH {_EXTRACT} SELECT '00000001' AS run_id, CAST(NULL AS VARCHAR) AS since_date,
  count(*) AS total_written, true AS has_batches, false AS dry_run, '2000-01-01' AS watermark FROM ext"""
ORACLE["responses_job"] = f"""WITH {REG}, hit AS (SELECT * FROM reg WHERE {_ANSWERED} AND gdat > '2000-01-01')
  SELECT '00000001' AS run_id, '2000-01-01' AS since_date, count(*) AS total_written, true AS has_batches,
  false AS dry_run, ({_NEW_MARK} FROM hit) AS watermark FROM hit"""
ORACLE["merge_reports"] = f"WITH {HISTORY} " + " UNION ALL ".join(
    f"SELECT '{run}' AS run, " + _merged(f"h{run}", f"TIMESTAMP '{run + 1}-01-01'") for run in RUNS
)
ORACLE["ensured_tables"] = f"""WITH {HISTORY} SELECT 'bronze' AS name, (SELECT count(*) FROM log) AS n
  UNION ALL SELECT 'watermark', 0 UNION ALL SELECT 'silver', (SELECT count(*) FROM h)"""
