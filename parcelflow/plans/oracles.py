"""The same results in plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

from parcelflow.schema import PROMOTED, PROMOTED_NAMES, Field

# The orders feed as the queries see it: page 3 of every seven without keys,
# page 6 of every seven empty, and the faults each record carries.
_FEED = """
WITH numbered AS (
  SELECT *, o_orderkey AS k, o_orderkey // 1000 + o_orderkey // 6000 AS page_no,
         CAST(o_orderkey % 1000 AS INTEGER) AS p,
         o_orderdate + to_microseconds((o_orderkey % 86400) * 1000000
                                       + (o_orderkey % 5) * 250000) AS modified,
         (SELECT max(o_orderkey) // 1000 + max(o_orderkey) // 6000 FROM orders) AS last_page
  FROM orders
), records AS (
  SELECT *, p AS pos,
         CASE WHEN page_no < last_page THEN 'page/' || CAST(page_no + 1 AS VARCHAR) END
           AS next_link,
         page_no % 7 <> 3 AND k % 97 NOT IN (13, 29, 31, 43) AS has_key,
         CASE WHEN k % 97 = 59 THEN '  ' || k || ' ' ELSE CAST(k AS VARCHAR) END AS listing_key,
         k % 101 IN (7, 11) AS bad_price,
         CASE WHEN k % 53 <> 0 THEN modified END AS sent_ts
  FROM numbered
), feed AS (
  SELECT * FROM records
  UNION ALL BY NAME
  SELECT page_no, last_page,
         CASE WHEN page_no < last_page THEN 'page/' || CAST(page_no + 1 AS VARCHAR) END
           AS next_link
  FROM (SELECT DISTINCT page_no + 1 AS page_no, last_page FROM numbered WHERE page_no % 7 = 5)
  WHERE page_no <= last_page
),
stored AS (SELECT * FROM records WHERE has_key AND NOT bad_price),
ledger AS (
  SELECT page_no,
         count(*) FILTER (pos IS NOT NULL AND has_key AND NOT bad_price) AS n_rows,
         count(*) FILTER (pos IS NOT NULL AND NOT has_key) AS n_skipped,
         count(*) FILTER (pos IS NOT NULL AND has_key AND bad_price) AS n_invalid,
         max(sent_ts) FILTER (pos IS NOT NULL AND has_key AND NOT bad_price) AS max_ts,
         max(next_link) AS next_link,
         TIMESTAMP '2024-06-01 11:00:00' + to_seconds((page_no + 1) * 2) AS committed_at
  FROM feed GROUP BY page_no
)
"""

_ORDER_ROWS = """
WITH base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "ListingKey", o_orderstatus AS "MlsStatus",
         CAST(o_totalprice AS DECIMAL(14,2)) AS "ListPrice",
         o_orderdate AS "ModificationTimestamp", o_orderkey AS k
  FROM orders
), sent AS (
  SELECT CASE WHEN o_orderkey % 3 = 1 THEN 'HOT'
              WHEN o_orderkey % 10 = 0 THEN 'N' || o_orderkey
              ELSE CAST(o_orderkey - o_orderkey % 2 AS VARCHAR) END AS "ListingKey",
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS "MlsStatus",
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) + 1 AS DECIMAL(14,2)) AS "ListPrice",
         o_orderdate + to_days(CAST(o_orderkey % 5 - 2 AS INTEGER)) AS "ModificationTimestamp",
         o_orderkey AS k
  FROM orders
), winners AS (
  SELECT * FROM sent QUALIFY row_number() OVER (PARTITION BY "ListingKey" ORDER BY k DESC) = 1
), merged AS (
  SELECT * FROM base WHERE "ListingKey" NOT IN (SELECT "ListingKey" FROM winners)
  UNION ALL SELECT * FROM winners
)
"""

_ROW = '"ListingKey", "MlsStatus", "ListPrice", "ModificationTimestamp"'

_EVENT_ROWS = """
  SELECT CAST(event_id AS VARCHAR) AS "ListingKey", event_type AS "MlsStatus",
         CAST({price} AS DECIMAL(14,2)) AS "ListPrice", ts AS "ModificationTimestamp"
  FROM events
"""

_STORED_MARK = (
    "(SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01')"
)


def _full_value(i: int, field: Field) -> str:
    """SQL for a promoted column of the clean feed, as its stored type."""
    special = {
        "ListingKey": "CAST(k AS VARCHAR)",
        "MlsStatus": "o_orderstatus",
        "ListPrice": "CAST(o_totalprice AS DECIMAL(14,2))",
        "ModificationTimestamp": "modified",
        "PropertyType": "o_orderpriority",
        "ListAgentKey": "CAST(o_custkey AS VARCHAR)",
    }
    if field.name in special:
        return special[field.name]
    if field.is_text and field.width == 2:
        value = f"CAST((k + {i}) % 90 + 10 AS VARCHAR)"
    elif field.is_text:
        value = f"'{field.name[:8]}-' || (k % {i + 7})"
    elif field.sql_type == "boolean":
        value = f"(k + {i}) % 2 = 0"
    elif field.sql_type in ("int", "smallint"):
        value = f"CAST((k * {i + 1}) % 1000 AS {field.sql_type})"
    elif field.sql_type.startswith("decimal"):
        value = (
            f"CAST(((k * {i + 3}) % 1000) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') "
            f"AS {field.sql_type})"
        )
    elif field.sql_type == "timestamp":
        value = f"o_orderdate + to_seconds(k % 3600 + {i * 3600})"
    else:
        value = f"CAST(o_orderdate + to_days({i}) AS DATE)"
    return f"CASE WHEN (k + {i}) % 5 <> 0 THEN {value} END"


_FULL_COLUMNS = ", ".join(
    f'{_full_value(i, f)} AS "{f.name}"' for i, f in enumerate(PROMOTED)
)

_SENT_FIELDS = (
    "'ListingKey'",
    "'ListingId'",
    "'MlsStatus'",
    "'InternetAddressDisplayYN'",
    "'ListPrice'",
    "'ModificationTimestamp'",
    "'CloseDate'",
    "'PhotosCount'",
    "'ListAgentKey'",
)

_REQUIRED = ", ".join(f"('{name}')" for name in PROMOTED_NAMES)

_POSITIONS = ", ".join(f"({n}, '{name}')" for n, name in enumerate(PROMOTED_NAMES))

_LOADED = "TIMESTAMP '2024-06-01 11:59:00'"

_ISO = (
    "strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {ts} <> date_trunc('second', {ts}) "
    "THEN strftime({ts}, '.%f') ELSE '' END || 'Z'"
)

ORACLES: dict[str, str] = {
    "page_flatten": _FEED
    + """
SELECT page_no, next_link, pos,
       CASE WHEN pos IS NOT NULL AND k % 3 <> 0 THEN 'ID-' || k END AS "ListingId",
       CASE WHEN pos IS NOT NULL THEN CAST(o_custkey AS VARCHAR) END AS "ListAgentKey"
FROM feed""",
    "page_chain": _FEED
    + """, cut AS (
  SELECT page_no, pos, CASE WHEN page_no <> last_page - 1 THEN next_link END AS next_link FROM feed
)
SELECT page_no, next_link, pos FROM cut
WHERE page_no <= (SELECT min(page_no) FROM cut WHERE next_link IS NULL)""",
    "full_scan": "SELECT * FROM orders ORDER BY o_orderdate",
    "incremental_scan": """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate > TIMESTAMP '1998-06-01'""",
    "since_override": f"""
SELECT 'given' AS bound, o_orderkey, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '2000-03-01'
UNION ALL
SELECT 'stored', o_orderkey, o_orderdate FROM orders WHERE o_orderdate > {_STORED_MARK}""",
    "incremental_from_ledger": f"""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > {_STORED_MARK}""",
    "late_rows": """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1996-02-29'""",
    "resume_pages": _FEED
    + """
SELECT page_no, next_link, pos FROM feed WHERE page_no > (
  SELECT coalesce(max(o_orderkey // 1000), -1) FROM orders
  WHERE o_orderkey // 1000 * 5 < (SELECT max(o_orderkey) // 1000 FROM orders) * 2)""",
    "paginate": """
SELECT o_orderkey, o_orderdate, rn // 1000 AS page_no, CAST(rn % 1000 AS INTEGER) AS pos
FROM (SELECT o_orderkey, o_orderdate,
             row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn FROM orders)""",
    "key_filter": _FEED + "SELECT page_no, pos, listing_key FROM records WHERE has_key",
    "skip_quarantine": _FEED
    + """
SELECT page_no, pos,
       CAST(1 + (k % 3 <> 0)::INTEGER + (sent_ts IS NOT NULL)::INTEGER AS INTEGER) AS n_known,
       CASE WHEN k % 3 <> 0 THEN 'ID-' || k END AS listing_id,
       CAST(o_custkey AS VARCHAR) AS agent_key
FROM records WHERE NOT has_key""",
    "promoted_projection": _FEED + f"SELECT {_FULL_COLUMNS} FROM numbered",
    "typed_casts": """
SELECT o_orderkey,
       CAST((o_orderkey % 1000 * 100 + (o_orderkey % 1000 + 5) // 10) / 100.0 AS DECIMAL(14,2))
         AS "ListPrice",
       CAST(o_orderkey % 300 AS SMALLINT) AS "Stories",
       o_orderkey % 6 IN (0, 2, 4) AS "SpaYN",
       CAST(o_orderdate AS DATE) AS "CloseDate",
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 40 AS INTEGER) END AS "PhotosCount"
FROM orders""",
    "missing_fields": _FEED
    + """
SELECT listing_key AS "ListingKey",
       CASE WHEN k % 3 <> 0 THEN 'ID-' || k END AS "ListingId",
       CASE WHEN k % 5 <> 0 THEN k % 2 = 0 END AS "InternetAddressDisplayYN",
       sent_ts AS "ModificationTimestamp",
       CASE WHEN k % 6 <> 0 THEN CAST(o_orderdate AS DATE) END AS "CloseDate",
       CASE WHEN k % 7 <> 0 THEN CAST(k % 50 AS INTEGER) END AS "PhotosCount"
FROM stored""",
    "validation_errors": _FEED
    + """
SELECT page_no, pos, listing_key AS "ListingKey", 'ListPrice' AS bad_fields
FROM records WHERE has_key AND bad_price""",
    "raw_payload": """
SELECT CAST(event_id AS VARCHAR) AS listing_key, user_id, event_type,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""",
    "unknown_fields": """
SELECT CAST(event_id AS VARCHAR) AS listing_key, 'Props,UserId' AS names, user_id,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""",
    "json_extract": """
SELECT CAST(event_id AS VARCHAR) AS listing_key,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k, user_id,
       CAST(NULL AS VARCHAR) AS absent
FROM events""",
    "utc_normalize": """
SELECT event_id, CASE WHEN event_id % 9 <> 4 THEN ts END AS ts, event_id % 9 = 4 AS rejected
FROM events""",
    "iso_z_format": f"""
SELECT event_id, CASE WHEN event_id % 4 = 0
  THEN {_ISO.format(ts="date_trunc('second', ts)")} ELSE {_ISO.format(ts="ts")} END AS iso
FROM events""",
    "hot_view": _FEED
    + f"SELECT {_FULL_COLUMNS}, {_LOADED} AS loaded_at FROM numbered",
    "raw_view": _FEED
    + f"""
SELECT listing_key AS "ListingKey", {_LOADED} AS loaded_at, 'S' || (o_custkey % 9) AS source,
       CAST(k % 4 AS INTEGER) AS n_media
FROM stored""",
    "batch_stamp": _FEED
    + f"""
SELECT listing_key AS "ListingKey", {_LOADED} AS loaded_at, {_LOADED} AS raw_loaded_at
FROM stored""",
    "hot_raw_join": _FEED
    + """
SELECT listing_key AS "ListingKey", o_orderstatus AS "MlsStatus",
       CASE WHEN k % 13 <> 0 THEN 'S' || (o_custkey % 9) END AS source
FROM stored ORDER BY 1""",
    "orphan_rows": _FEED
    + """
SELECT listing_key AS "ListingKey", o_orderstatus AS "MlsStatus"
FROM stored WHERE k % 13 = 0""",
    "upsert_current": _ORDER_ROWS + f"SELECT {_ROW} FROM merged",
    "upsert_classify": _ORDER_ROWS
    + """
SELECT w."ListingKey", CASE WHEN b."ListingKey" IS NULL THEN 'inserted' ELSE 'updated' END
       AS action, w."ListPrice"
FROM winners w LEFT JOIN base b ON w."ListingKey" = b."ListingKey" """,
    "upsert_idempotent": _ORDER_ROWS
    + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences FROM merged",
    "bulk_replace": _EVENT_ROWS.format(
        price="CASE WHEN event_id % 1000 % 3 = 0 THEN 1.5 ELSE value END"
    ),
    "committed_only": """
SELECT o_orderkey // 1000 AS batch_id, CAST(o_orderkey AS VARCHAR) AS "ListingKey",
       CAST(o_totalprice AS DECIMAL(14,2)) AS "ListPrice"
FROM orders WHERE (o_orderkey // 1000) % 4 <> 3""",
    "batch_ledger": _FEED
    + "SELECT page_no, n_rows, n_skipped, n_invalid, max_ts, next_link FROM ledger",
    "progress_ledger": _FEED
    + """, so_far AS (
  SELECT page_no, n_rows, row_number() OVER w AS batch_no,
         CAST(sum(n_rows) OVER w AS BIGINT) AS cumulative_rows,
         max(max_ts) OVER w AS running_max_ts,
         CAST((page_no + 1) * 2 AS DOUBLE) AS elapsed_seconds
  FROM ledger
  WINDOW w AS (ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT page_no, batch_no, n_rows, cumulative_rows, running_max_ts, elapsed_seconds,
       round(batch_no / elapsed_seconds * 60.0, 2) AS requests_per_minute
FROM so_far""",
    "state_transitions": _FEED
    + """
SELECT page_no, max(max_ts) OVER (ORDER BY page_no) AS watermark,
       next_link IS NOT NULL AS in_progress, next_link,
       CASE WHEN next_link IS NOT NULL THEN committed_at END AS link_saved_at
FROM ledger""",
    "run_summary": _FEED
    + """
SELECT CAST(page_no % 3 AS INTEGER) AS run_no, CAST(sum(n_rows) AS BIGINT) AS total_rows,
       count(*) AS n_pages, max(max_ts) AS watermark,
       CAST(max((page_no + 1) * 2) AS DOUBLE) AS elapsed_seconds
FROM ledger GROUP BY 1""",
    "run_watermark": """
SELECT feed, greatest(max(CASE WHEN feed <> 9 THEN o_orderdate END),
                      CASE WHEN feed = 7 THEN TIMESTAMP '2005-01-01'
                           WHEN feed % 5 = 0 THEN NULL
                           ELSE TIMESTAMP '1996-01-01' END) AS watermark
FROM (SELECT o_custkey % 25 AS feed, o_orderdate FROM orders) GROUP BY feed""",
    "oversized_batches": """
SELECT o_custkey // 100 AS page_no, count(*) AS n_rows FROM orders
GROUP BY 1 HAVING count(*) > 1000""",
    "resume_decision": """
WITH latest AS (
  SELECT o_custkey AS feed, o_orderkey AS k, o_orderkey % 7 <> 0 AS in_progress,
         o_orderkey % 481 AS age, o_orderkey % 5 = 0 AS unmarked, o_orderkey % 2 = 0 AS full_mode
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
), decided AS (
  SELECT *, CASE WHEN NOT in_progress THEN 'fresh' WHEN age < 240 THEN 'resume'
                 WHEN unmarked THEN 'error' ELSE 'pivot' END AS any_mode FROM latest
)
SELECT feed, k AS batch_id, any_mode,
       CASE WHEN full_mode THEN any_mode ELSE 'fresh' END AS same_mode
FROM decided""",
    "load_audit": _FEED
    + """
SELECT count(*) AS n_rows, min(sent_ts) AS min_ts, max(sent_ts) AS max_ts,
       count(DISTINCT o_orderstatus) AS n_statuses,
       count(*) FILTER (k % 13 <> 0) AS n_raw_rows,
       count(*) FILTER (k % 13 = 0) AS n_orphans
FROM stored""",
    "watermark_check": _FEED
    + """
SELECT max(sent_ts) AS max_ts, (SELECT max(max_ts) FROM ledger) AS watermark, true AS agrees
FROM stored""",
    "crash_invariant": """
WITH observed AS (
  SELECT o_orderkey, o_orderdate,
         (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) AS rn FROM orders
), paged AS (
  SELECT o_orderkey, o_orderdate, rn // 1000 AS page_no, CAST(rn % 1000 AS INTEGER) AS pos
  FROM observed
), stored AS (SELECT * FROM paged WHERE page_no * 2 < (SELECT max(page_no) FROM paged))
SELECT * FROM paged WHERE o_orderdate <= (SELECT max(o_orderdate) FROM stored)
  AND o_orderkey NOT IN (SELECT o_orderkey FROM stored)""",
    "schema_conformance": f"""
WITH required(column_name) AS (VALUES {_REQUIRED})
SELECT column_name FROM required
WHERE column_name NOT IN ({", ".join(_SENT_FIELDS)}) AND EXISTS (SELECT 1 FROM orders)""",
    "indexed_lookup": _ORDER_ROWS
    + f"""
SELECT {_ROW} FROM base
WHERE "MlsStatus" = 'F' AND "ListPrice" BETWEEN 100000 AND 150000""",
    "table_catalog": """
SELECT 'property' AS table_name, CAST(63 AS INTEGER) AS n_columns,
       CAST(0 AS INTEGER) AS n_missing, count(*) AS n_rows FROM customer
UNION ALL
SELECT 'property_raw', CAST(3 AS INTEGER), CAST(61 AS INTEGER), count(*) FROM customer""",
    "csv_dialect": r"""
SELECT c_custkey,
  '"' || c_custkey || '",' ||
  '"' || CASE WHEN c_custkey % 5 = 0 THEN c_name || ', \"x\\y\"' ELSE c_name END || '",' ||
  CASE WHEN c_custkey % 7 = 0 THEN '\N' ELSE '"' || c_mktsegment || '"' END || ',' ||
  '"' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || '",' ||
  CASE WHEN c_custkey % 2 = 0 THEN '"1"' ELSE '"0"' END || ',' ||
  '"' || strftime(TIMESTAMP '2024-06-01 11:00:00' + to_seconds(c_custkey), '%Y-%m-%d %H:%M:%S')
      || CASE WHEN c_custkey % 2 = 1 THEN '.001500' ELSE '' END || '",' ||
  '"' || strftime(DATE '2024-06-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') || '"'
  AS line
FROM customer""",
    "dry_run_summary": _FEED
    + """
SELECT count(*) FILTER (has_key AND NOT bad_price) AS n_rows,
       count(*) FILTER (NOT has_key) AS n_skipped,
       max(sent_ts) FILTER (has_key AND NOT bad_price) AS max_ts
FROM records""",
    "recreate_reload": _EVENT_ROWS.format(price="value"),
    "continued_run": _EVENT_ROWS.format(
        price="CASE WHEN event_id // 1000 % 2 = 0 AND event_id % 1000 % 3 = 0 THEN 1.50 ELSE value END"
    ),
    "chain_end_load": _EVENT_ROWS.format(price="value")
    + "WHERE event_id // 1000 <= greatest((SELECT max(event_id) // 1000 FROM events) - 1, 0)",
    "stream_pages": _EVENT_ROWS.format(price="value"),
    "planned_sync": """
WITH sizes AS (
  SELECT max(event_id) // 1000 + 1 AS pages, count(*) AS n,
         count(*) FILTER (event_id // 1000 < (SELECT max(event_id) // 1000 FROM events)) AS n_open,
         count(*) FILTER (event_id % 3 = 0) AS n_third, count(*) FILTER (event_id % 6 = 0) AS n_moved
  FROM events
), runs AS (
  SELECT 'a' AS run_key, 'full' AS mode, pages AS n_pages, n AS n_rows FROM sizes
  UNION ALL SELECT 'b', 'full', pages, n FROM sizes WHERE pages = 1
  UNION ALL SELECT 'c', 'full', pages - 1, n_open FROM sizes WHERE pages > 1
  UNION ALL SELECT 'd', CASE WHEN pages > 1 THEN 'incremental' ELSE 'full' END, pages,
                   CASE WHEN pages > 1 THEN n_moved ELSE n_third END FROM sizes
  UNION ALL SELECT 'e', 'incremental', pages, n_moved FROM sizes
)
SELECT run_key, mode, CAST(n_pages AS BIGINT) AS n_pages, CAST(n_rows AS BIGINT) AS n_rows,
       CAST(n_pages AS BIGINT) AS last_batch_no, CAST(n_rows AS BIGINT) AS cumulative_rows,
       (SELECT CASE WHEN pages > 1 THEN n_moved ELSE n_third END FROM sizes) AS n_moved
FROM runs""",
    "store_options": """
SELECT 'k' || event_id AS key,
       CASE WHEN event_id % 6 = 0 THEN 'k' ELSE 'K' END || event_id AS "ListingKey",
       CASE WHEN event_id % 6 = 0 THEN 'second' ELSE 'first' END AS "MlsStatus",
       CASE WHEN event_id % 6 = 0 THEN 'second' ELSE 'first' END AS raw_status
FROM events""",
    "typed_conformance": f"""
WITH required(position, column_name) AS (VALUES {_POSITIONS}),
sent AS (SELECT o_orderkey AS k, o_orderkey % 1009 <> 5 AS whole FROM orders),
counted(column_name, sent, n_missing, n_null, n_other_type, n_too_long) AS (
  SELECT 'ListingKey', 'STRING', count(*) FILTER (NOT whole OR k % 97 = 13), 0, 0, 0 FROM sent
  UNION ALL SELECT 'City', 'STRING', count(*) FILTER (NOT whole), 0, 0, 0 FROM sent
  UNION ALL SELECT 'StateOrProvince', 'STRING', count(*) FILTER (NOT whole), 0, 0,
                   count(*) FILTER (whole AND k % 11 = 3) FROM sent
  UNION ALL SELECT 'ListPrice', 'STRING', count(*) FILTER (NOT whole OR (k % 5 = 0 AND k % 101 <> 7)), 0,
                   count(*) FILTER (whole AND k % 101 = 7), 0 FROM sent
  UNION ALL SELECT 'Stories', 'VARIANT', count(*) FILTER (NOT whole), 0,
                   count(*) FILTER (whole AND k % 13 = 4), 0 FROM sent
  UNION ALL SELECT 'BedroomsTotal', 'BIGINT', count(*) FILTER (NOT whole OR k % 3 = 0),
                   count(*) FILTER (whole AND k % 3 <> 0 AND k % 4 = 1), 0, 0 FROM sent
  UNION ALL SELECT 'SpaYN', 'BOOLEAN', count(*) FILTER (NOT whole), 0, 0, 0 FROM sent
), every AS (
  SELECT CAST(position AS INTEGER) AS position, r.column_name, coalesce(sent, 'VOID') AS sent,
         (SELECT count(*) FROM orders) AS n_payloads,
         CAST(coalesce(n_missing, (SELECT count(*) FROM orders)) AS BIGINT) AS n_missing,
         CAST(coalesce(n_null, 0) AS BIGINT) AS n_null,
         CAST(coalesce(n_other_type, 0) AS BIGINT) AS n_other_type,
         CAST(coalesce(n_too_long, 0) AS BIGINT) AS n_too_long
  FROM required r LEFT JOIN counted c ON r.column_name = c.column_name
)
SELECT *, CASE WHEN n_missing + n_null = n_payloads THEN 'missing' WHEN n_other_type > 0 THEN 'other type'
               WHEN n_too_long > 0 THEN 'too long' WHEN n_missing + n_null > 0 THEN 'nullable'
               ELSE 'sound' END AS verdict
FROM every""",
    "table_conformance": f"""
WITH required(position, column_name) AS (VALUES {_POSITIONS}),
measured(column_name, actual, longest, n_null, verdict) AS (
  SELECT 'ListingKey', 'string', max(length(CAST(o_orderkey AS VARCHAR))), 0, 'sound' FROM orders
  UNION ALL SELECT 'MlsStatus', 'string', max(length(o_orderstatus)), 0, 'sound' FROM orders
  UNION ALL SELECT 'ListPrice', 'decimal(14,2)', NULL, 0, 'sound'
  UNION ALL SELECT 'ModificationTimestamp', 'timestamp', NULL, count(*) FILTER (o_orderkey % 9 = 4), 'nullable' FROM orders
  UNION ALL SELECT 'StateOrProvince', 'string', max(o_orderkey % 5), 0, 'too long' FROM orders
  UNION ALL SELECT 'Stories', 'bigint', NULL, 0, 'other type'
)
SELECT CAST(position AS INTEGER) AS position, r.column_name, actual, CAST(longest AS INTEGER) AS longest,
       CAST(coalesce(n_null, (SELECT count(*) FROM orders)) AS BIGINT) AS n_null,
       coalesce(verdict, 'missing') AS verdict
FROM required r LEFT JOIN measured m ON r.column_name = m.column_name""",
    "multi_column_lookup": _ORDER_ROWS
    + f"""
SELECT 'price' AS search, {_ROW} FROM base WHERE "ListPrice" BETWEEN 100000 AND 120000
UNION ALL
SELECT 'time', {_ROW} FROM base WHERE "ModificationTimestamp" >= TIMESTAMP '2000-06-01'""",
    "page_by_number": """
SELECT o_orderkey, o_orderdate, CAST(1 AS BIGINT) AS page_no, CAST(rn - 1000 AS INTEGER) AS pos
FROM (SELECT o_orderkey, o_orderdate,
             row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn FROM orders)
WHERE rn // 1000 = 1""",
    "incremental_by_folder": f"""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > {_STORED_MARK}""",
    "sketched_audit": _FEED
    + """
SELECT (SELECT count(*) FROM ledger) AS n_batches, count(*) AS n_rows, min(sent_ts) AS min_ts,
       max(sent_ts) AS max_ts, count(DISTINCT o_orderstatus) AS n_statuses,
       count(DISTINCT listing_key) AS n_keys_exact, true AS keys_within
FROM stored""",
    "differing_rows": _ORDER_ROWS.replace("FROM orders\n), winners", "FROM orders WHERE o_orderkey % 1000 < 10\n), winners")
    + f"""
SELECT *, 'left' AS side FROM (SELECT {_ROW} FROM base EXCEPT ALL SELECT {_ROW} FROM merged)
UNION ALL
SELECT *, 'right' FROM (SELECT {_ROW} FROM merged EXCEPT ALL SELECT {_ROW} FROM base)""",
    "bulk_read_back": r"""
SELECT c_custkey,
       CASE WHEN c_custkey % 5 = 0 THEN c_name || ', "x\y"'
            WHEN c_custkey % 11 = 0 THEN chr(10) || '"' || chr(10) || c_name || '\' || chr(10) || chr(13) || chr(10)
            WHEN c_custkey % 13 = 0 THEN '\N' ELSE c_name END AS name,
       CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment,
       CAST(c_acctbal AS DECIMAL(12,2)) AS balance, c_custkey % 2 = 0 AS flag,
       TIMESTAMP '2024-06-01 11:00:00' + to_microseconds(c_custkey * 1000000 + (c_custkey % 2) * 1500) AS seen,
       CASE WHEN c_custkey % 3 <> 0 THEN DATE '2024-06-01' + CAST(c_custkey % 365 AS INTEGER) END AS day
FROM customer""",
    "stream_progress": """
SELECT CAST((max(event_id) // 1000 + 1 + 15) // 16 AS BIGINT) AS n_batches,
       CAST(max(event_id) // 1000 + 1 AS BIGINT) AS n_pages, CAST(count(*) AS BIGINT) AS n_rows,
       max(ts) AS max_ts, count(*) AS n_stored
FROM events""",
}
ORACLES["streamed_resume_decision"] = ORACLES["resume_decision"]
