"""Expected results of the queries, stated in DuckDB SQL over the same tables."""

from __future__ import annotations

US, RS, CR, LF = "chr(31)", "chr(30)", "chr(13)", "chr(10)"

_DAY = "strftime(o_orderdate, '%Y-%m-%d')"

_ORDER_LINE = f"concat_ws('~', o_custkey, {_DAY}, {_DAY}, 'JOB' || o_orderkey, '/land/data/' || o_custkey || '/feed/finished/' || {_DAY} || '/')"

_CATALOG = """
SELECT CASE WHEN p_retailprice < 905 THEN 'stage' ELSE 'edw' END AS databasename,
  CASE WHEN p_type = 'PROMO' THEN p_brand ELSE lower(p_brand) END AS tablename,
  CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_name || ' ' || p_partkey END AS columntitle,
  p_partkey AS columnid,
  CASE WHEN p_size <= 5 THEN 'Ignore' WHEN p_size <= 10 THEN 'ETL' WHEN p_size <= 20 THEN NULL
       WHEN p_size <= 25 THEN 'Remove' ELSE 'note' END AS commentstring
FROM part"""

_GOLDEN = """
SELECT databasename, tablename AS entity, columnid AS column_id,
  lower(replace(columntitle, ' ', '_')) AS column_name, commentstring AS comment
FROM catalog WHERE lower(tablename) = tablename AND coalesce(commentstring, '') NOT IN ('Ignore', 'ETL')
  AND coalesce(columntitle, '') <> ''"""

# Customer rows by nation and segment. verdict and shape follow from how the query builds them.
_CUSTOMERS = f"""
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS org_id,
  CASE WHEN c_nationkey NOT IN (0, 1, 6) AND c_mktsegment = 'MACHINERY' THEN 'bad_arity'
       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'bad_number' ELSE 'ok' END AS verdict,
  CASE WHEN c_nationkey = 6 THEN 5 WHEN c_nationkey > 1 AND c_mktsegment = 'MACHINERY' THEN 3 ELSE 4 END AS n_fields,
  CAST(c_custkey AS VARCHAR) AS key,
  CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR)
    || CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'x' ELSE '' END AS bal,
  CASE WHEN c_nationkey IN (0, 1, 6) THEN c_mktsegment ELSE ' ' END AS seg,
  c_nationkey < 2 AS reversed
FROM customer
WHERE c_nationkey NOT IN (5, 7) AND (c_nationkey IN (0, 1, 6) OR c_mktsegment <> 'FURNITURE')"""

_ROUTED = f"""
SELECT c_custkey, org_id, verdict, CAST(NULL AS VARCHAR) AS file_verdict, n_fields,
  CASE WHEN verdict = 'ok' THEN key || {US} || {US} || bal || {US} || seg
       WHEN verdict = 'bad_arity' THEN key || {US} || {US} || bal
       WHEN reversed THEN seg || {US} || {US} || bal || {US} || key
       ELSE key || {US} || {US} || bal || {US} || seg END
    || {US} || '0' || {US} || 'J1' || {US} || 'customer_' || org_id AS value
FROM rows_
UNION ALL
SELECT DISTINCT NULL, CAST(c_nationkey AS VARCHAR), 'file',
  CASE c_nationkey WHEN 5 THEN 'schema_mismatch' WHEN 7 THEN 'bad_header' ELSE 'ok' END, NULL, NULL
FROM customer"""


def _load(orgs: str, dates: str, job: str, validate: bool) -> str:
    """Rows of an orders feed; orders of practice 4 come in files with a wrong header."""
    number = "o_orderstatus = 'P'" if validate else "false"
    return f"""
WITH feed AS (
  SELECT substr(o_orderpriority, 1, 1) AS org_id, strftime(o_orderdate, '%Y') || '-01-01' AS feed_date,
    CASE WHEN o_totalprice < 20000 THEN 'bad_arity' WHEN {number} THEN 'bad_number' ELSE 'ok' END AS verdict,
    CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS st,
    CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)
      || CASE WHEN o_orderstatus = 'P' THEN 'e1' ELSE '' END AS price,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE ' ' END || o_orderpriority AS pri
  FROM orders),
files AS (SELECT *, {job} AS job FROM feed WHERE org_id IN ({orgs}) AND feed_date LIKE '{dates}')
SELECT verdict, 'orders' AS entity, org_id, feed_date, CAST(NULL AS VARCHAR) AS file_verdict,
  CASE WHEN verdict = 'bad_arity' THEN 3 ELSE 5 END AS n_fields,
  CASE verdict WHEN 'bad_arity' THEN concat_ws({US}, key, st, '', '0', job)
    WHEN 'bad_number' THEN concat_ws({US}, key, st, '', price, pri, '0', job)
    ELSE concat_ws({US}, key, price, '', pri, st, '0', job) END AS value
FROM files WHERE org_id <> '4'
UNION ALL
SELECT DISTINCT 'file', 'orders', org_id, feed_date,
  CASE org_id WHEN '4' THEN 'schema_mismatch' ELSE 'ok' END, NULL, NULL
FROM files"""


_COUNTED = """SELECT org_id, feed_date, count(*) FILTER (verdict = 'ok') AS n_ok, count(*) FILTER (verdict = 'bad_arity') AS n_bad_arity,
  count(*) FILTER (verdict = 'file') AS n_file, 1 AS n_loads FROM loaded"""
_ZEROS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("n_ok", "n_bad_arity", "n_file", "n_loads"))

ORACLES = {
    "frame_records": f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS rec_no, value FROM (
  SELECT doc_id, unnest(string_split(text, {LF})) AS value,
    generate_subscripts(string_split(text, {LF}), 1) AS i FROM documents)
WHERE i > 4 AND NOT regexp_full_match(value, '[\\x00-\\x20]*')""",
    "clean_record": f"""
SELECT doc_id, replace(replace(replace(
  replace(replace(text, ' ', {CR}), '.', '.' || {RS}), {CR}, ' '), {LF}, ''), {RS}, '') AS value FROM documents""",
    "control_jobid": f"""
SELECT o_orderkey, p[1] AS facility, p[2] AS from_date, p[3] AS to_date, p[4] AS job_id, p[5] AS path,
  replace(line, '~', {US}) AS fields
FROM (SELECT o_orderkey, {_ORDER_LINE} AS line, string_split({_ORDER_LINE}, '~') AS p FROM orders)""",
    "first_line_per_file": "SELECT conv_id, arg_min(text, turn) AS line FROM conversations GROUP BY conv_id",
    "manifest_parse": """
SELECT event_id,
  CASE WHEN event_type = 'error' THEN '' ELSE name || '.asv' END AS file_name,
  CASE WHEN event_type = 'error' THEN '' ELSE split_part(name, '_', 1) END AS entity,
  CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS practice_id,
  CASE WHEN event_type IN ('view', 'signup') THEN NULL ELSE n END AS row_count,
  CASE WHEN event_type = 'view' THEN 'single_field' WHEN event_type = 'signup' THEN 'bad_count'
       WHEN n = 0 THEN 'zero_rows' WHEN event_type = 'error' THEN 'bad_name' ELSE 'ok' END AS status
FROM (SELECT *, CAST(floor(value) AS BIGINT) AS n,
  event_type || '_4.0_' || strftime(ts, '%Y%m%d%H%M%S') || '_' || user_id AS name FROM events)""",
    "path_parts": f"""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS org_id, {_DAY} AS feed_date,
  '/land/data/' || o_custkey || '/feed/finished/' || {_DAY} || '/' AS dir,
  lower(o_orderpriority) || '_4.0_' || o_orderkey || '.asv' AS file_name,
  lower(o_orderpriority) AS entity,
  '/land/data/P' || o_orderkey || '/feed/finished/' || {_DAY} || '/' AS practice_dir,
  lower(o_orderpriority) || '.' || o_orderkey || '.txt' AS output_name
FROM orders""",
    "classify_files": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'manifest' WHEN 'O' THEN 'control'
  ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'unrecognised' ELSE 'data' END END AS kind FROM orders""",
    "date_prefix_scan": f"""
SELECT o_orderkey, '/land/data/' || o_custkey || '/feed/finished/' || {_DAY} || '/x_1.asv' AS file_path,
  {_DAY} AS feed_date FROM orders WHERE {_DAY} LIKE '1997-0%' OR {_DAY} = '1998-12-31'""",
    "facility_route": """
SELECT CAST(c_custkey AS VARCHAR) AS facility,
  CASE WHEN c_custkey = 25 THEN 'all' WHEN c_custkey IN (SELECT s_suppkey FROM supplier) THEN 'divisional'
       ELSE 'path' END AS run_type,
  CASE WHEN c_custkey = 25 THEN '/land/data/*/feed/finished'
       ELSE '/land/data/' || c_custkey || '/feed/finished' END AS run_source
FROM customer""",
    "allowlist_semi": """
SELECT o_orderkey FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
  AND o_orderpriority < '4'""",
    "allowlist_anti": """
SELECT o_orderkey FROM orders WHERE o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
    "division_list": """
SELECT 'c' || c_custkey AS division_id, 'C' || c_custkey AS practice_id, upper(c_mktsegment) AS entity FROM customer""",
    "entity_param": """
SELECT event_id, 'one' AS request FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, 'all' FROM events""",
    "control_semi_join": """
SELECT CAST(c_custkey AS VARCHAR) AS org_id FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "control_contains_join": """
SELECT CAST(s_suppkey AS VARCHAR) AS org_id FROM supplier WHERE EXISTS (
  SELECT 1 FROM (SELECT DISTINCT '/land/data/' || o_custkey || '/feed/' AS path FROM orders) m
  WHERE contains(m.path, CAST(s_suppkey AS VARCHAR)))""",
    "manifest_expand": """
SELECT o_orderkey, '/land/data/' || o_orderkey || '/feed/finished/2015-09-01/lineitem_4.0_' || o_orderkey || '.asv' AS file_path,
  '/land/data/' || o_orderkey || '/feed/finished/2015-09-01/CONTROL.TXT' AS control_path,
  o_orderkey IN (SELECT l_orderkey FROM lineitem) AS found
FROM orders""",
    "distinct_control_paths": """
SELECT DISTINCT '/land/data/' || l_suppkey || '/feed/finished/2015-09-01/CONTROL.TXT' AS control_path FROM lineitem""",
    "jobid_left_join": """
SELECT c_custkey, coalesce('JOB' || k, '') AS job_id FROM customer LEFT JOIN
  (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
  ON c_custkey = o_custkey""",
    "paths_by_entity": """
SELECT DISTINCT upper(event_type) AS entity, '/land/' || user_id || '/' || event_type AS path FROM events""",
    "entity_sizes": """
SELECT upper(event_type) AS entity, count(DISTINCT user_id) AS n_paths FROM events GROUP BY event_type""",
    "consolidate_union": """
SELECT 'customer' AS entity, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""",
    "golden_schema": f"""
WITH catalog AS ({_CATALOG}), golden AS ({_GOLDEN})
SELECT entity, column_id, column_name, comment,
  row_number() OVER (PARTITION BY entity ORDER BY column_id) - 1 AS ordinal
FROM golden WHERE databasename = 'edw'""",
    "pii_flag": f"""
WITH catalog AS ({_CATALOG}), golden AS ({_GOLDEN})
SELECT entity, bool_or(lower(coalesce(comment, '')) = 'remove') AS has_pii FROM golden GROUP BY entity""",
    "catalog_counts": """
SELECT 'T' || l_orderkey AS tablename, count(*) AS n_columns FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag <> 'A' AND o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' GROUP BY l_orderkey""",
    "warehouse_query": """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "schema_match": """
WITH h AS (
  SELECT o_orderkey,
    CASE o_orderstatus WHEN 'F' THEN ['order_key', 'cust_key', 'order_status']
      WHEN 'O' THEN ['cust_key', 'cust_key', 'order_status', 'order_key', 'total']
      ELSE ['order_key', 'order,_status'] END AS names,
    CASE WHEN o_totalprice < 50000 THEN ['NUMBER', 'NUMBER']
      ELSE ['NUMBER', 'VARCHAR', 'NUMBER', 'X', 'NUMBER'] END AS types,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN ['order_key', 'cust_key', 'order_status']
      WHEN o_orderpriority = '3-MEDIUM' THEN ['order_key', 'cust_key', 'order_status', 'total']
      WHEN o_orderpriority = '5-LOW' THEN ['order_status', 'cust_key', 'order_key'] END AS golden,
    o_orderpriority = '3-MEDIUM' AS pii FROM orders)
SELECT o_orderkey,
  CASE WHEN golden IS NULL THEN 'no_golden_schema' WHEN len(types) < len(names) THEN 'bad_header'
    WHEN len(list_filter(golden, lambda g: list_contains(names, g))) < len(golden) THEN 'schema_mismatch'
    ELSE 'ok' END AS file_verdict,
  CAST(len(names) AS INTEGER) AS width,
  coalesce(names <> golden, false) AS reorder,
  array_to_string(list_transform(golden, lambda g: CASE WHEN list_contains(names, g)
    THEN len(names) - list_position(list_reverse(names), g) + 1 ELSE 0 END), ',') AS positions,
  CASE WHEN golden IS NOT NULL THEN coalesce(array_to_string(list_filter(names, lambda n: NOT list_contains(golden, n)), ','), '') END AS extra_columns,
  array_to_string(list_filter(range(len(types)), lambda i: types[i + 1] = 'NUMBER'
    AND NOT (pii AND i < len(names) AND coalesce(names[i + 1], '') = 'total')), ',') AS numeric
FROM h""",
    "header_map": f"""
WITH h AS (
  SELECT doc_id, string_split(rtrim(text, {LF}), {LF}) AS names,
    string_split(rtrim(replace(replace(text, '. ', {US}), {LF}, ''), {US}), {US}) AS types FROM documents),
p AS (SELECT doc_id, types, unnest(names) AS title, generate_subscripts(names, 1) AS i FROM h WHERE len(types) >= len(names))
SELECT doc_id, title, types[i] AS type FROM p QUALIFY i = max(i) OVER (PARTITION BY doc_id, title)
UNION ALL SELECT doc_id, NULL, NULL FROM h WHERE len(types) < len(names)""",
    "needs_reorder": """
SELECT c_custkey, c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS reorder FROM customer""",
    "numeric_positions": """
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_quantity > 25 THEN '0' END,
  CASE WHEN l_discount > 0.05 THEN '1' END, CASE WHEN l_returnflag = 'A' THEN '2' END) AS positions FROM lineitem""",
    "reorder_columns": f"""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment || {US} || '' || {US} || c_custkey
  ELSE c_custkey || {US} || '' || {US} || c_mktsegment END AS value FROM customer""",
    "pii_blank": f"""
SELECT c_custkey, {US} || c_custkey AS source_order, c_custkey || {US} || {US} AS golden_order FROM customer""",
    "numeric_check": """
WITH e AS (SELECT event_id, event_type AS t, CAST(round(value * 100) AS BIGINT) AS c FROM events),
v AS (SELECT event_id, trim(CASE WHEN c < 50 THEN '' WHEN t = 'click' THEN '' || c WHEN t = 'view' THEN ' ' || c || '.' || c || ' '
  WHEN t = 'signup' THEN c || 'L' WHEN t = 'error' THEN '1e' || c WHEN c > 10000 THEN '99999999999999' || c
  ELSE '.' || c || 'd' END) AS v FROM e),
n AS (SELECT event_id, CASE WHEN v = '' THEN true
  WHEN contains(v, '.') THEN regexp_full_match(v, '[+-]?([0-9]+[.][0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[dDfF]?')
  ELSE regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS HUGEINT) BETWEEN -9223372036854775808 AND 9223372036854775807
  END AS ok FROM v)
SELECT event_id, coalesce(ok, false) AS is_number, coalesce(ok, false) AS row_ok FROM n""",
    "arity_check": """
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 3 WHEN 'N' THEN 4 ELSE 5 END AS n_fields,
  l_returnflag = 'N' AS arity_ok FROM lineitem""",
    "audit_columns": f"""
SELECT o_orderkey, concat_ws({US}, o_orderkey, o_orderstatus, '', '0', 'JOB' || o_custkey, 'orders_' || {_DAY} || '.asv') AS value
FROM orders""",
    "route_rows": f"WITH rows_ AS ({_CUSTOMERS}) {_ROUTED}",
    "run_audit": f"""
WITH rows_ AS ({_CUSTOMERS}) SELECT 'customer' AS entity, count(*) FILTER (verdict = 'ok') AS n_ok,
  count(*) FILTER (verdict <> 'ok') AS n_rejected,
  (SELECT count(DISTINCT c_nationkey) FROM customer WHERE c_nationkey IN (5, 7)) AS n_rejected_files,
  (SELECT count(*) FROM supplier WHERE s_nationkey < 5) AS n_missing_files, (SELECT count(*) FROM nation) AS n_bad_manifest_rows,
  'errors' AS state
FROM rows_
UNION ALL SELECT 'vendor', 0, 0, 0, count(*), 0, 'errors' FROM supplier WHERE s_nationkey >= 5 HAVING count(*) > 0""",
    "text_sink": f"""
WITH rows_ AS ({_CUSTOMERS}), routed AS ({_ROUTED})
SELECT verdict, CASE WHEN verdict = 'file' THEN '/land/' || org_id || {US} || file_verdict ELSE value END AS value
FROM routed WHERE verdict <> 'file' OR file_verdict <> 'ok'""",
    "typed_view": f"""
WITH rows_ AS ({_CUSTOMERS}) SELECT key AS cust_key, CAST(NULL AS VARCHAR) AS name, bal AS balance, seg AS segment,
  '0' AS load_flag, 'J1' AS job_id, 'customer_' || org_id AS source_file FROM rows_ WHERE verdict = 'ok'""",
    "ingest_directory": _load("'1', '2', '3', '4'", "199%", "CASE org_id WHEN '3' THEN '' ELSE 'JOB' || org_id END", True),
    "ingest_manifest": _load("'1', '3', '4'", "199%", "''", False),
    "ingest_large_files": f"""
WITH loaded AS ({_load("'1', '2', '3', '4'", "199%", "''", True)})
SELECT org_id, feed_date, count(*) FILTER (verdict = 'ok') AS n_ok, count(*) FILTER (verdict = 'bad_arity') AS n_bad_arity,
  count(*) FILTER (verdict = 'bad_number') AS n_bad_number, count(*) FILTER (verdict = 'file') AS n_file,
  count(*) FILTER (verdict <> 'file') AS n_numbers,
  CASE WHEN count(*) > 1 THEN 4 END AS first_number, CASE WHEN count(*) > 1 THEN count(*) + 2 END AS last_number
FROM loaded GROUP BY org_id, feed_date""",
    "requested_runs": f"""
WITH loaded AS ({_load("'1', '2', '3', '4'", "%", "''", True)}),
counted AS (SELECT org_id, feed_date, verdict, count(*) AS n_rows FROM loaded WHERE verdict <> 'file' GROUP BY ALL),
asked AS (
  SELECT DISTINCT org_id AS facility, feed_date AS from_date FROM loaded
  UNION ALL SELECT DISTINCT org_id, '199*' FROM loaded WHERE org_id < '3'
  UNION ALL SELECT * FROM (VALUES ('2208', '1995*'), ('9999', '1996-01-01')))
SELECT concat_ws('_', 'J', facility, from_date) || '/' || facility || '_' || from_date AS request, org_id, feed_date, verdict, n_rows
FROM asked JOIN counted ON feed_date LIKE replace(from_date, '*', '%')
  AND (org_id = facility OR facility IN ('2208', '9999') AND org_id <> '2')""",
    "poll_arrivals": f"""
WITH loaded AS ({_load("'1', '2', '3', '4'", "%", "''", False)}),
counted AS ({_COUNTED} WHERE org_id <> '3' OR feed_date < '1995' GROUP BY org_id, feed_date),
late AS (SELECT DISTINCT org_id, feed_date, 1 AS n FROM loaded WHERE org_id = '3')
SELECT org_id, feed_date, {_ZEROS}, coalesce(n, 0) AS n_late FROM counted FULL JOIN late USING (org_id, feed_date)""",
    "stream_manifest": f"""
WITH loaded AS ({_load("'1', '3'", "%", "''", False)}),
counted AS ({_COUNTED} GROUP BY org_id, feed_date),
years AS (SELECT DISTINCT strftime(o_orderdate, '%Y') || '-01-01' AS feed_date, unnest(['1', '3']) AS org_id FROM orders)
SELECT org_id, feed_date, {_ZEROS}, CASE WHEN feed_date < '1995' AND n_loads = 1 THEN 1 ELSE 2 END AS n_missing
FROM years LEFT JOIN counted USING (org_id, feed_date)""",
    "published_runs": f"""
WITH loaded AS ({_load("'1', '3', '4'", "199%", "''", False)}),
places AS (SELECT substr(o_orderpriority, 1, 1) AS org_id, strftime(o_orderdate, '%Y') || '-01-01' AS feed_date,
    CAST(ceil(count(*) / 1000000) AS BIGINT) AS n_files FROM orders
  WHERE substr(o_orderpriority, 1, 1) <> '2' AND strftime(o_orderdate, '%Y') LIKE '199%' GROUP BY ALL)
SELECT 'rows' AS part, verdict AS what, CAST(sum(CASE verdict WHEN 'file' THEN n_files ELSE 1 END) AS BIGINT) AS n
FROM loaded JOIN places USING (org_id, feed_date) GROUP BY verdict
UNION ALL SELECT 'files', file_verdict, CAST(sum(n_files) AS BIGINT) FROM loaded JOIN places USING (org_id, feed_date)
  WHERE file_verdict <> 'ok' GROUP BY file_verdict
UNION ALL SELECT 'missing', '', count(*) FROM places WHERE org_id <> '5' HAVING count(*) > 0
UNION ALL SELECT 'manifest', '', CAST(sum(n_files + 1) AS BIGINT) FROM places HAVING count(*) > 0
UNION ALL SELECT 'control', '1', count(*) FROM places WHERE org_id = '1' HAVING count(*) > 0
UNION ALL SELECT 'control', '2208', count(DISTINCT feed_date) FROM places HAVING count(*) > 0
UNION ALL SELECT 'status', '2208 load ' || unnest(['started', 'completed with errors']), 2""",
    "warehouse_load": f"""
WITH rows_ AS ({_CUSTOMERS}), typed AS (SELECT key AS cust_key, seg AS segment FROM rows_ WHERE verdict = 'ok')
SELECT cust_key, segment, 'R2' AS run_id, 'all' AS load_key, '2024-01-03' AS load_day FROM typed
UNION ALL SELECT cust_key, segment, 'R1', 'building', '2024-01-02' FROM typed WHERE segment = 'BUILDING'""",
    "stream_arrivals": _load("'1', '2', '4'", "%", "'JOB' || org_id", False),
}
