"""DuckDB SQL equivalents of :mod:`flatlake.standins` (the correctness oracle).

Each string runs on the driver's tables registered as views.  Queries that
only exist as file operations without a relational equivalent (raw copies,
listings of written files) have no entry here.
"""

from __future__ import annotations

from .config import ASSET_CLASSES, KNOWN_DATASETS
from .standins import EVENT_DATASETS, RUN_SIGNATURE


def _values(pairs, cols) -> str:
    rows = ", ".join(f"('{a}', '{b}')" for a, b in sorted(pairs))
    return f"(SELECT * FROM (VALUES {rows}) t({cols}))"


ALIASES = _values(KNOWN_DATASETS.items(), "alias, prefix")
CLASSES = _values(ASSET_CLASSES.items(), "asset_alias, asset_prefix")

ORDERS_KEYS = """
orders_keys AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice,
    (CASE WHEN o_orderstatus = 'F' THEN 'us_stocks_sip' WHEN o_orderstatus = 'O' THEN 'us_options_opra'
          ELSE 'global_crypto' END) || '/' ||
    (CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'trades_v1' WHEN '2' THEN 'quotes_v1'
          WHEN '3' THEN 'minute_aggs_v1' WHEN '4' THEN 'day_aggs_v1' ELSE 'day_aggs_v2' END) AS prefix,
    CAST(o_orderdate AS DATE) AS o_date
  FROM orders
),
orders_keys2 AS (
  SELECT *, CASE WHEN o_orderkey % 50 = 0
      THEN prefix || '/' || strftime(o_date, '%Y/%m') || '/notes-' || strftime(o_date, '%Y%m%d') || '.txt'
      ELSE prefix || '/' || strftime(o_date, '%Y/%m/%Y-%m-%d') || '.csv.gz' END AS key
  FROM orders_keys
),
listing AS (
  SELECT key, CAST(count(*) AS VARCHAR) || '-' || CAST(min(o_orderkey) AS VARCHAR) AS etag, count(*) AS size
  FROM orders_keys2 GROUP BY key
)"""

EVENTS_LISTING = """
ev_keys AS (
  SELECT *, 'us_events/' || event_type || '_v1/' || strftime(CAST(ts AS DATE), '%Y/%m/%Y-%m-%d') || '.csv.gz' AS key
  FROM events
),
listing AS (
  SELECT key, CAST(count(*) AS VARCHAR) || '-' || CAST(min(event_id) AS VARCHAR) AS etag, count(*) AS size
  FROM ev_keys GROUP BY key
)"""

CATALOG = r"""
cat0 AS (
  SELECT key, etag, size,
    NULLIF(regexp_extract(key, '^([^/]+/[^/]+)/', 1), '') AS dataset,
    regexp_extract(key, '([^/]*)$', 1) AS filename
  FROM listing
),
cat1 AS (
  SELECT *, TRY_CAST(NULLIF(regexp_extract(filename, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), '') AS DATE) AS file_date
  FROM cat0
),
catalog AS (
  SELECT dataset,
    split_part(dataset, '/', 1) AS asset_class,
    split_part(dataset, '/', 2) AS data_type,
    regexp_replace(split_part(dataset, '/', 2), '_v[0-9]+$', '') AS name,
    file_date,
    CAST(NULLIF(regexp_extract(key, '^[^/]+/[^/]+/([0-9]{4})/([0-9]{2})/[^/]+$', 1), '') AS INTEGER) AS dir_year,
    CAST(NULLIF(regexp_extract(key, '^[^/]+/[^/]+/([0-9]{4})/([0-9]{2})/[^/]+$', 2), '') AS INTEGER) AS dir_month,
    key, etag, size, filename,
    regexp_extract(filename, '^[^.]*\.(.*)$', 1) AS extension
  FROM cat1
  WHERE dataset IS NOT NULL AND file_date IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _month_idx(y: int, m: int) -> int:
    return y * 12 + m - 1


ISO_NS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || 'Z'"

PLAN_FILES = f"""
files AS (
  SELECT *, dataset || '/' || strftime(file_date, '%Y/%m/%Y-%m-%d') || '.parquet' AS rel FROM catalog
),
m AS (
  SELECT rel, CASE WHEN size % 5 = 0 THEN 'old-' || etag ELSE etag END AS m_etag,
    CASE WHEN dir_month = 12 THEN 'other' ELSE '{RUN_SIGNATURE}' END AS m_sig,
    size % 3 <> 0 AS m_written
  FROM files WHERE size % 4 <> 0
),
o AS (SELECT DISTINCT rel FROM files WHERE size % 2 = 0),
j AS (
  SELECT f.rel, f.key, m.rel IS NOT NULL AS has, o.rel IS NOT NULL AS ex,
    (m.m_etag = f.etag AND m.m_sig = '{RUN_SIGNATURE}') AS cur, coalesce(m.m_written, false) AS wr
  FROM files f LEFT JOIN m ON f.rel = m.rel LEFT JOIN o ON f.rel = o.rel
),
p AS (
  SELECT rel, key,
    CASE WHEN has AND NOT coalesce(cur, false) THEN 'changed'
         WHEN has AND (NOT wr OR ex) THEN 'up to date'
         WHEN has THEN 'output missing'
         WHEN ex THEN 'exists'
         ELSE 'new' END AS reason
  FROM j
),
plan AS (
  SELECT rel, key, CASE WHEN reason IN ('up to date', 'exists') THEN 'skip' ELSE 'pull' END AS action, reason FROM p
)"""

MANIFEST_LOG = """
log AS (
  SELECT rel, key, etag, size AS rows, true AS written,
    CAST(file_date AS TIMESTAMP) + INTERVAL 6 HOUR + INTERVAL 1 DAY AS completed_at, 'run-1' AS run_id, 'record' AS op
  FROM files
  UNION ALL
  SELECT rel, key, 'v2-' || etag, size * 2, size % 3 <> 0,
    CAST(file_date AS TIMESTAMP) + INTERVAL 6 HOUR + INTERVAL 2 DAY, 'run-2', 'record'
  FROM files WHERE size % 2 = 0
  UNION ALL
  SELECT rel, NULL, NULL, NULL, NULL,
    CAST(file_date AS TIMESTAMP) + INTERVAL 6 HOUR + INTERVAL 2 DAY, 'run-3', 'forget'
  FROM files WHERE day(file_date) % 7 = 0
),
cur AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY rel ORDER BY completed_at DESC, run_id DESC) AS rn FROM log
  ) WHERE rn = 1 AND op = 'record'
)"""

_EVENT_SET = ", ".join(f"'{d}'" for d in EVENT_DATASETS)

_OUTCOMES = """
WITH months AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, l_partkey, l_linenumber FROM lineitem),
files AS (
  SELECT m, count(*) FILTER (WHERE l_partkey % 3 = 1) AS hits,
    month(m) = 3 AND count(*) FILTER (WHERE l_linenumber = 1) > 0 AS bad FROM months GROUP BY m),
outcomes AS (
  SELECT CAST(m AS VARCHAR) AS file_date,
    CASE WHEN bad THEN 'failed' WHEN month(m) = 7 OR hits = 0 THEN 'empty' ELSE 'written' END AS status,
    CASE WHEN bad THEN NULL WHEN month(m) = 7 THEN 0 ELSE hits END AS rows
  FROM files
  UNION ALL
  SELECT CAST(make_date(year(max(m)) + 1, 1, 1) AS VARCHAR), 'empty', 0 FROM files)
"""

SQL: dict[str, str] = {
    "filter_in_or_prefix": "SELECT * FROM part WHERE p_brand IN ('Brand#2') OR starts_with(p_brand, 'Brand#1')",
    "filter_in": "SELECT * FROM part WHERE p_brand IN ('Brand#2', 'Brand#25')",
    "filter_prefix": "SELECT * FROM part WHERE starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#3')",
    "filter_cast_prefix": "SELECT * FROM orders WHERE starts_with(CAST(o_orderkey AS VARCHAR), '12')",
    "filter_cast_double": (
        "SELECT * FROM part WHERE regexp_replace(CAST(p_retailprice AS VARCHAR), '\\.0$', '') IN ('901', '950.5') "
        "OR starts_with(regexp_replace(CAST(p_retailprice AS VARCHAR), '\\.0$', ''), '99')"
    ),
    "project": "SELECT o_orderpriority, o_orderdate, o_orderkey, o_totalprice FROM orders",
    "row_filter": "SELECT * FROM lineitem WHERE l_quantity > 25",
    "epoch_to_ts": (
        "SELECT event_id, date_trunc('second', ts) AS ts_s, date_trunc('millisecond', ts) AS ts_ms, "
        "ts AS ts_us, ts AS ts_ns FROM events"
    ),
    "epoch_auto": (
        "SELECT event_id, user_id, event_type, value, ts AS sip_timestamp, epoch_us(ts) * 1000 AS sip_timestamp_ns, "
        "ts AS participant_timestamp, epoch_us(ts) * 1000 + event_id % 1000 AS participant_timestamp_ns FROM events"
    ),
    "iso_timestamp": (
        f"SELECT event_id, {ISO_NS} AS iso_ns, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso_ms, "
        "strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso_s FROM events"
    ),
    "extract_underlying": r"""
WITH t AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 3 = 0 THEN
      'O:' || upper(regexp_replace(p_type, '[^A-Za-z]', '', 'g'))
        || lpad(CAST(p_partkey % 1000000 AS VARCHAR), 6, '0')
        || CASE WHEN p_size % 2 = 0 THEN 'C' ELSE 'P' END
        || lpad(CAST(CAST(round(p_retailprice * 1000) AS BIGINT) AS VARCHAR), 8, '0')
    WHEN p_partkey % 3 = 1 THEN 'O:' || p_brand
    ELSE p_name END AS ticker
  FROM part
)
SELECT p_partkey, ticker,
  CASE WHEN ticker IS NULL THEN NULL ELSE coalesce(
    NULLIF(regexp_extract(ticker, '^O:([A-Z]+)[0-9]{6}[CP][0-9]{8}$', 1), ''),
    NULLIF(regexp_extract(regexp_replace(ticker, '^O:', ''), '^(\p{L}+)', 1), ''),
    'UNKNOWN') END AS underlying
FROM t""",
    "dataset_parts": _with(ORDERS_KEYS, CATALOG) + r"""
SELECT key, dataset, split_part(dataset, '/', 1) AS asset_class, split_part(dataset, '/', 2) AS data_type,
  regexp_replace(split_part(dataset, '/', 2), '_v[0-9]+$', '') AS name, filename,
  regexp_extract(filename, '^[^.]*\.(.*)$', 1) AS extension, CAST(file_date AS VARCHAR) AS file_date
FROM cat1""",
    "key_for_date": _with(ORDERS_KEYS) + """
SELECT DISTINCT prefix, CAST(o_date AS VARCHAR) AS file_date, prefix || '/' || strftime(o_date, '%Y/%m') || '/' AS month_prefix,
  prefix || '/' || strftime(o_date, '%Y/%m/%Y-%m-%d') || '.csv.gz' AS key
FROM orders_keys""",
    "render_path": _with(ORDERS_KEYS, CATALOG) + """
SELECT key,
  dataset || '/' || strftime(file_date, '%Y') || '/' || strftime(file_date, '%m') || '/' || strftime(file_date, '%Y-%m-%d') || '.parquet' AS rel_default,
  asset_class || '/' || name || '/' || strftime(file_date, '%Y') || '/' || strftime(file_date, '%d') || '/'
    || strftime(file_date, '%Y-%m-%d') || '_' || data_type || '.' || extension AS rel_custom,
  name || '/' || filename AS rel_raw
FROM catalog""",
    "iter_months": """
WITH s AS (
  SELECT o_orderpriority, date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi
  FROM orders GROUP BY o_orderpriority
)
SELECT o_orderpriority, strftime(m, '%Y-%m') AS month
FROM (SELECT o_orderpriority, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM s)""",
    "resolve_dataset": f"""
WITH e AS (
  SELECT event_type,
    list_extract(['stocks', 'options', 'indices', 'forex', 'crypto', 'bogus'], CAST(user_id % 6 + 1 AS INTEGER)) AS a,
    CASE WHEN event_type = 'view' THEN 'trades' WHEN event_type = 'click' THEN 'quotes' ELSE event_type END AS d
  FROM events
),
n AS (
  SELECT DISTINCT CASE WHEN event_type = 'error' THEN '  ' || event_type || ' '
    WHEN event_type = 'signup' THEN ' /' || a || '/' || d || '/ '
    ELSE a || '/' || d END AS name
  FROM e
),
c AS (
  SELECT name, regexp_replace(regexp_replace(name, '^\\s+|\\s+$', '', 'g'), '^/+|/+$', '', 'g') AS clean FROM n
),
c2 AS (SELECT *, string_split(clean, '/') AS parts FROM c)
SELECT c2.name,
  CASE WHEN clean = '' THEN NULL WHEN a.prefix IS NOT NULL THEN a.prefix
       WHEN k.asset_prefix IS NOT NULL THEN k.asset_prefix || '/' || parts[2]
       WHEN len(parts) >= 2 AND NOT list_contains(parts, '') THEN clean END AS prefix,
  CASE WHEN clean = '' THEN 'invalid' WHEN a.prefix IS NOT NULL THEN 'alias'
       WHEN k.asset_prefix IS NOT NULL THEN 'asset_class'
       WHEN len(parts) >= 2 AND NOT list_contains(parts, '') THEN 'prefix' ELSE 'invalid' END AS resolved_by
FROM c2 LEFT JOIN {ALIASES} a ON c2.clean = a.alias
LEFT JOIN {CLASSES} k ON len(c2.parts) = 2 AND c2.parts[1] = k.asset_alias""",
    "datasets_without_files": """
SELECT dataset FROM (SELECT event_type AS dataset FROM events UNION SELECT lower(r_name) FROM region) r
WHERE NOT EXISTS (
  SELECT 1 FROM events e WHERE e.event_type = r.dataset
    AND CAST(e.ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10')""",
    "signature": """
SELECT o_orderpriority, s AS signature, sha256(s) AS signature_sha FROM (
  SELECT o_orderpriority,
    '{"column":"o_orderstatus","in":["' || array_to_string(list_sort(list_distinct(list(o_orderstatus))), '","')
    || '"],"prefix":["' || array_to_string(list_sort(list_distinct(list(substr(CAST(o_custkey AS VARCHAR), 1, 1)))), '","') || '"]}' AS s
  FROM orders GROUP BY o_orderpriority)""",
    "catalog": _with(ORDERS_KEYS, CATALOG) + """
SELECT dataset, asset_class, data_type, name, CAST(file_date AS VARCHAR) AS file_date, dir_year, dir_month,
  key, etag, size, filename, extension
FROM catalog""",
    "rows_per_file": _with(ORDERS_KEYS) + "SELECT key, count(*) AS rows FROM orders_keys2 WHERE o_orderstatus = 'F' GROUP BY key",
    "date_range": _with(ORDERS_KEYS, CATALOG) + f"""
SELECT key, dataset, CAST(file_date AS VARCHAR) AS file_date FROM catalog
WHERE dataset IN ('us_stocks_sip/trades_v1', 'us_options_opra/quotes_v1', 'global_crypto/day_aggs_v2')
  AND dir_year * 12 + dir_month - 1 BETWEEN {_month_idx(1996, 3)} AND {_month_idx(1996, 6)}
  AND file_date BETWEEN DATE '1996-03-15' AND DATE '1996-06-10'""",
    "latest_one": _with(ORDERS_KEYS, CATALOG) + f"""
SELECT key, dataset, CAST(file_date AS VARCHAR) AS file_date FROM catalog
WHERE dataset = 'us_stocks_sip/trades_v1'
  AND dir_year * 12 + dir_month - 1 BETWEEN {_month_idx(2001, 12) - 23} AND {_month_idx(2001, 12)}
ORDER BY file_date DESC, key LIMIT 1""",
    "latest_n": _with(EVENTS_LISTING, CATALOG) + f"""
SELECT key, dataset, CAST(file_date AS VARCHAR) AS file_date, row_number() OVER (ORDER BY file_date, key) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY file_date DESC, key) AS rn FROM catalog
  WHERE dataset IN ({_EVENT_SET})
    AND dir_year * 12 + dir_month - 1 BETWEEN {_month_idx(2024, 2) - 23} AND {_month_idx(2024, 2)}
) WHERE rn <= 3""",
    "list_datasets": _with(ORDERS_KEYS) + f"""
, p AS (
  SELECT DISTINCT regexp_extract(key, '^([^/]+/[^/]+)/', 1) AS prefix FROM listing
  WHERE regexp_extract(key, '^([^/]+/[^/]+)/', 1) <> ''
)
SELECT p.prefix, a.alias, split_part(p.prefix, '/', 1) AS asset_class, split_part(p.prefix, '/', 2) AS data_type,
  regexp_replace(split_part(p.prefix, '/', 2), '_v[0-9]+$', '') AS name
FROM p LEFT JOIN {ALIASES} a ON p.prefix = a.prefix""",
    "list_dates": _with(ORDERS_KEYS) + "SELECT key FROM listing WHERE starts_with(key, 'us_stocks_sip/trades_v1/1997/03/')",
    "union_datasets": _with(ORDERS_KEYS, CATALOG) + f"""
SELECT key, dataset, CAST(file_date AS VARCHAR) AS file_date FROM catalog
WHERE dataset IN ('us_stocks_sip/trades_v1', 'us_options_opra/quotes_v1', 'global_crypto/day_aggs_v2')
  AND dir_year * 12 + dir_month - 1 BETWEEN {_month_idx(1997, 1)} AND {_month_idx(1997, 12)}
  AND file_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
    "union_schemas": """
SELECT l_orderkey AS k, CAST(l_linenumber AS DOUBLE) AS n, l_returnflag AS tag, CAST(NULL AS VARCHAR) AS tag2 FROM lineitem
UNION ALL
SELECT o_orderkey, o_totalprice, NULL, o_orderstatus FROM orders""",
    "plan_incremental": _with(ORDERS_KEYS, CATALOG, PLAN_FILES) + "SELECT rel, key, action, reason FROM plan",
    "plan_status_counts": _with(ORDERS_KEYS, CATALOG, PLAN_FILES)
    + "SELECT action, reason, count(*) AS files FROM plan GROUP BY action, reason",
    "plan_new_files": _with(ORDERS_KEYS, CATALOG, PLAN_FILES)
    + "SELECT rel, key FROM files WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.rel = files.rel)",
    "manifest_current": _with(ORDERS_KEYS, CATALOG, PLAN_FILES, MANIFEST_LOG)
    + "SELECT rel, key, etag, rows, written, completed_at, run_id FROM cur",
    "manifest_forget": _with(ORDERS_KEYS, CATALOG, PLAN_FILES, MANIFEST_LOG)
    + "SELECT DISTINCT rel FROM log WHERE rel NOT IN (SELECT rel FROM cur)",
    "empty_partitions": _with(EVENTS_LISTING, CATALOG) + """
SELECT c.key, CAST(0 AS BIGINT) AS rows FROM catalog c
WHERE NOT EXISTS (SELECT 1 FROM ev_keys k WHERE k.key = c.key AND k.value > 250)""",
    "republish_overwrite": """
SELECT event_id, event_type,
  CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-15' THEN value * 2 ELSE value END AS value,
  strftime(ts, '%Y-%m-%d') AS day
FROM events""",
    "scan_csv": "SELECT * FROM orders",
    "sink_raw": "SELECT * FROM orders",
    "sink_raw_ranges": "SELECT * FROM orders",
    "listing": "SELECT o_orderstatus AS folder, count(*) AS rows, true AS filled, true AS has_etag FROM orders GROUP BY o_orderstatus",
    "infer_schema": """
SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'bigint'), (2, 'o_orderstatus', 'string'),
  (3, 'o_totalprice', 'double'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string'))
  t(position, "column", type)""",
    "type_override": """
SELECT * FROM (VALUES (0, 'o_orderkey', 'bigint'), (1, 'o_custkey', 'int'), (2, 'o_orderstatus', 'string'),
  (3, 'o_totalprice', 'float'), (4, 'o_orderdate', 'timestamp_ntz'), (5, 'o_orderpriority', 'string'))
  t(position, "column", type)""",
    "failed_files": """
SELECT l_returnflag, l_linestatus, count(*) FILTER (WHERE l_orderkey % 997 = 0) AS bad_rows, count(*) AS total_rows
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "stream_available_now": "SELECT event_id, event_type, value FROM events",
    "ingest_events": """
SELECT 'U' || CAST(user_id AS VARCHAR) AS ticker, value, ts AS sip_timestamp,
  epoch_us(ts) * 1000 + event_id % 1000 AS sip_timestamp_ns, event_type || '_v1' AS data_type,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date
FROM events WHERE starts_with('U' || CAST(user_id AS VARCHAR), 'U1')""",
    "stream_ingest_events": """
SELECT 'U' || CAST(user_id AS VARCHAR) AS ticker, event_type, value, ts AS sip_timestamp,
  epoch_us(ts) * 1000 + event_id % 1000 AS sip_timestamp_ns, CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date
FROM events WHERE starts_with('U' || CAST(user_id AS VARCHAR), 'U1')""",
    "ingest_two_files_per_day": """
SELECT event_id, 'U' || CAST(user_id AS VARCHAR) AS ticker,
  CASE WHEN event_id % 2 = 1 AND CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events) THEN value * 2 ELSE value END AS value,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date
FROM events""",
    "ingest_schema_drift": """
SELECT event_id, 'U' || CAST(user_id AS VARCHAR) AS ticker,
  CASE WHEN day(CAST(ts AS DATE)) <= 15 THEN floor(value) ELSE value END AS value,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date
FROM events""",
    "ingest_outcomes": _OUTCOMES + "SELECT file_date, status, rows FROM outcomes",
    "ingest_status_counts": _OUTCOMES + "SELECT status, count(*) AS files FROM outcomes GROUP BY status",
    "ingest_lineitem": """
SELECT 'L' || CAST(l_partkey AS VARCHAR) AS ticker, l_extendedprice AS price, l_quantity AS size,
  make_timestamp(epoch_us(l_shipdate) + (l_orderkey * 10 + l_linenumber) // 1000) AS sip_timestamp,
  epoch_us(l_shipdate) * 1000 + l_orderkey * 10 + l_linenumber AS sip_timestamp_ns,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS file_date
FROM lineitem""",
    "flagship": _with(EVENTS_LISTING, CATALOG) + f"""
, latest AS (
  SELECT key FROM (
    SELECT key, row_number() OVER (PARTITION BY dataset ORDER BY file_date DESC, key) AS rn FROM catalog
    WHERE dataset IN ({_EVENT_SET})
      AND dir_year * 12 + dir_month - 1 BETWEEN {_month_idx(2024, 2) - 23} AND {_month_idx(2024, 2)}
  ) WHERE rn <= 3
)
SELECT key, event_type, count(*) AS rows, min({ISO_NS}) AS first_iso, max(ts) AS last_ts
FROM ev_keys
WHERE key IN (SELECT key FROM latest)
  AND ('U' || CAST(user_id AS VARCHAR) IN ('U7') OR starts_with('U' || CAST(user_id AS VARCHAR), 'U1'))
GROUP BY key, event_type""",
}

_SINK_BINARY = "SELECT event_id, event_type, value, ts, epoch_us(ts) * 1000 + event_id % 1000 AS ts_ns, props FROM events"
_SINK_TEXT = f"SELECT event_id, event_type, value, {ISO_NS} AS ts_text, props FROM events"
SQL.update({
    "sink_parquet": _SINK_BINARY,
    "sink_feather": _SINK_BINARY,
    "sink_csv": _SINK_TEXT,
    "sink_csv_gz": _SINK_TEXT,
    "sink_jsonl": _SINK_TEXT,
    "sink_jsonl_gz": _SINK_TEXT,
})

SQL.update({
    "ingest_batch_then_stream": """
SELECT event_id, 'U' || CAST(user_id AS VARCHAR) AS ticker,
  CASE WHEN CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM events) THEN value * 2 ELSE value END AS value,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date
FROM events""",
    "quoted_lines": """
SELECT o_orderkey, o_orderpriority || chr(10) || '"said", ' || CAST(o_orderkey AS VARCHAR)
  || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || chr(10) || 'end' ELSE '' END AS note,
  o_totalprice, false AS _row_bad
FROM orders""",
    "file_row_order": """
SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) - 1 AS place, l_orderkey, l_linenumber
FROM lineitem""",
    "filter_ticker_sets": """
SELECT l_orderkey, l_linenumber, 'L' || CAST(l_partkey AS VARCHAR) AS ticker FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size % 5 = 0)
  OR EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 4 = 1 AND starts_with('L' || CAST(l_partkey AS VARCHAR), 'L' || CAST(s_suppkey AS VARCHAR) || '7'))""",
    "type_hints": """
SELECT "column", type, CASE WHEN type = 'string' THEN n ELSE 0 END AS filled, n AS rows
FROM (VALUES ('otc', 'boolean'), ('conditions', 'string'), ('correction', 'bigint'), ('remark', 'string')) t("column", type), (SELECT count(*) AS n FROM orders)""",
    "jsonl_fallbacks": "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) AS price, o_orderpriority AS priority FROM orders",
    "ingest_force_dry_run": """
SELECT step, status, reason, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS days
FROM (VALUES (0, 'planned', 'new'), (1, 'written', 'new'), (2, 'skipped', 'up to date'), (3, 'planned', 'force'), (4, 'written', 'force')) t(step, status, reason)""",
    "ingest_underlying": """
SELECT event_id, 'O:KIT' || strftime(ts, '%y%m%d') || 'C' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS ticker, value,
  CASE WHEN event_id % 2 = 0 THEN 'trades_v1' ELSE 'quotes_v1' END AS data_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS file_date
FROM events WHERE event_id % 3 = 1""",
})
