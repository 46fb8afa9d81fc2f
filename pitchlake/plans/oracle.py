"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Written independently of the Spark code: where the Spark side uses an equi-join
on a computed chunk, an aggregate instead of a window, or a segmented scan, the
SQL here uses the textbook form (range predicate, ROW_NUMBER, a plain window), so
the comparison checks the rewrite as well as the result.
"""

from __future__ import annotations

from pitchlake.plans.game_queries import GAME_SQL
from pitchlake.plans.storage_queries import STORAGE_SQL

ORACLE: dict[str, str] = {}

ORACLE["arsenal"] = """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines,
       ROUND(100.0::DOUBLE * COUNT(*) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 1) AS usage_pct,
       ROUND(AVG(l_quantity), 1) AS avg_qty,
       ROUND(AVG(l_extendedprice)) AS avg_price,
       ROUND(AVG(l_discount), 2) AS avg_disc,
       ROUND(AVG(l_tax), 2) AS avg_tax
FROM lineitem
GROUP BY l_returnflag, l_linestatus
ORDER BY n_lines DESC
"""

ORACLE["name_lookup"] = """
SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE p_name ILIKE '%ring%'
"""

ORACLE["top_entities"] = """
SELECT l.l_suppkey, COUNT(*) AS n_lines
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderdate >= TIMESTAMP '1997-01-01' AND o.o_orderdate < TIMESTAMP '1998-01-01'
  AND o.o_orderstatus = 'F'
GROUP BY l.l_suppkey
ORDER BY n_lines DESC, l.l_suppkey
LIMIT 30
"""

ORACLE["ledger_audit"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice
FROM orders
WHERE (o_orderdate >= TIMESTAMP '2001-01-01' OR o_orderdate < TIMESTAMP '1995-02-01')
ORDER BY o_orderstatus, o_orderdate
"""

ORACLE["ledger_failed"] = """
SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'error' ORDER BY ts DESC
"""

_WEEK_COVER = """
SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start
FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
  AND o_orderdate >= TIMESTAMP '1997-03-07' AND o_orderdate < TIMESTAMP '1997-11-01'
"""

ORACLE["week_gaps"] = f"""
SELECT CAST(d AS DATE) AS week_start
FROM (SELECT unnest(generate_series(DATE '1997-03-07', DATE '1997-10-31', INTERVAL 7 DAY)) AS d)
EXCEPT
{_WEEK_COVER}
ORDER BY week_start
"""

ORACLE["week_gaps_aligned"] = f"""
SELECT CAST(d AS DATE) AS week_start
FROM (SELECT unnest(generate_series(CAST(date_trunc('week', DATE '1997-03-07') AS DATE),
                                    DATE '1997-10-31', INTERVAL 7 DAY)) AS d)
EXCEPT
{_WEEK_COVER}
ORDER BY week_start
"""

ORACLE["games_by_year"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_orders
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY 1
"""

ORACLE["counts_by_year"] = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, COUNT(*) AS n_lines
FROM lineitem GROUP BY 1 ORDER BY 1
"""

ORACLE["events_by_day"] = """
SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n_events FROM events GROUP BY 1 ORDER BY 1
"""

ORACLE["view_rows_by_day"] = """
SELECT CAST(e.ts AS DATE) AS day, COUNT(*) AS view_rows, COUNT(c.c_name) AS named_rows
FROM events e LEFT JOIN customer c ON c.c_custkey = TRY_CAST(e.props->>'k' AS INTEGER)
GROUP BY 1 ORDER BY 1
"""

ORACLE["entity_year_counts"] = """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
       COUNT(*) AS n_lines, COUNT(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY 1, 2
"""

ORACLE["fanout_check"] = """
SELECT c.c_custkey, c.c_name,
       COUNT(DISTINCT o.o_orderkey) AS n_orders,
       COUNT(l.l_linenumber) AS n_lines
FROM customer c
JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT'
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE c.c_mktsegment = 'BUILDING'
GROUP BY c.c_custkey, c.c_name
"""

ORACLE["orphans_pair"] = """
SELECT COUNT(*) AS orphaned_lines
FROM lineitem l
WHERE NOT EXISTS (
  SELECT 1 FROM lineitem r
  WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_suppkey = l.l_suppkey)
"""

ORACLE["orphans_parent"] = """
SELECT COUNT(*) AS orders_without_lines
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

ORACLE["orphans_child"] = """
SELECT COUNT(*) AS lines_without_order
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
"""

ORACLE["missing_dim_ids"] = """
SELECT DISTINCT d.doc_id
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
ORDER BY d.doc_id LIMIT 20
"""

ORACLE["null_rates"] = """
SELECT d.lang, COUNT(*) AS total_docs,
       ROUND(100.0::DOUBLE * COUNT(l.doc_id) / COUNT(*), 1) AS pct_has_label,
       ROUND(100.0::DOUBLE * COUNT(l.quality) / COUNT(*), 1) AS pct_has_quality,
       ROUND(100.0::DOUBLE * COUNT(l.toxic) / COUNT(*), 1) AS pct_has_toxic,
       ROUND(100.0::DOUBLE * COUNT(d.source) / COUNT(*), 1) AS pct_has_source
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
GROUP BY d.lang ORDER BY d.lang
"""

ORACLE["source_coverage"] = """
SELECT a.lang, a.n_docs, b.n_labels,
       ROUND(100.0::DOUBLE * b.n_labels / NULLIF(a.n_docs, 0), 1) AS label_coverage_pct
FROM (SELECT lang, COUNT(*) AS n_docs FROM documents GROUP BY lang) a
LEFT JOIN (SELECT d.lang, COUNT(*) AS n_labels
           FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY d.lang) b
USING (lang)
ORDER BY a.lang
"""

ORACLE["view_filter"] = """
SELECT e.event_id, e.ts, c.c_name AS customer_name, e.value, TRY_CAST(e.props->>'k' AS INTEGER) AS k
FROM events e JOIN customer c ON c.c_custkey = TRY_CAST(e.props->>'k' AS INTEGER)
WHERE c.c_mktsegment = 'BUILDING' AND e.event_type = 'purchase'
ORDER BY e.ts
"""

ORACLE["metric_by_group"] = """
SELECT event_type, COUNT(*) AS n, ROUND(AVG(value), 2) AS avg_value
FROM events GROUP BY event_type ORDER BY event_type
"""

ORACLE["metric_trend"] = """
WITH d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n, SUM(value) AS s FROM events GROUP BY 1)
SELECT day, n, ROUND(s / n, 3) AS avg_value,
       ROUND(SUM(s) OVER w / SUM(n) OVER w, 3) AS avg_value_7d
FROM d
WINDOW w AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
ORDER BY day
"""

ORACLE["event_rate"] = """
SELECT user_id, COUNT(*) AS n_events,
       COUNT(*) FILTER (WHERE event_type = 'purchase') AS n_purchases,
       ROUND(CAST(COUNT(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) / COUNT(*), 3) AS purchase_rate
FROM events GROUP BY user_id
"""

ORACLE["dup_keys"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
"""

ORACLE["not_null_check"] = """
WITH j AS (SELECT d.lang, d.source, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'lang' AS column_name, COUNT(*) - COUNT(lang) AS null_count, COUNT(*) AS total_rows FROM j
UNION ALL SELECT 'source', COUNT(*) - COUNT(source), COUNT(*) FROM j
UNION ALL SELECT 'quality', COUNT(*) - COUNT(quality), COUNT(*) FROM j
UNION ALL SELECT 'toxic', COUNT(*) - COUNT(toxic), COUNT(*) FROM j
"""

ORACLE["scan_filter_window"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate
FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'
  AND o_orderstatus IN ('F', 'O')
"""

ORACLE["union_stamped"] = """
SELECT c_custkey AS entity_id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, 'customer' AS kind
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), 'supplier' FROM supplier
"""

ORACLE["csv_round_trip"] = "SELECT * FROM supplier"
ORACLE["csv_round_trip_texts"] = "SELECT * FROM documents"

ORACLE["select_tolerant"] = "SELECT s_suppkey, s_name, s_nationkey FROM supplier"

ORACLE["rename_keep"] = """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment FROM customer
"""

ORACLE["coerce_types"] = """
SELECT event_id, user_id, value, CAST(props->>'k' AS INTEGER) AS k,
       CAST(ts AS DATE) AS day, event_type = 'error' AS is_error
FROM events
"""

ORACLE["json_extract"] = """
SELECT event_id, props->>'k' AS k_text, TRY_CAST(props->>'k' AS INTEGER) AS k_int,
       TRY_CAST(props->>'k' AS DOUBLE) AS k_double, props->>'missing' AS missing_text
FROM events
"""

ORACLE["unpack_view"] = """
SELECT e.event_id, e.user_id, e.ts, e.event_type, e.value,
       TRY_CAST(e.props->>'k' AS INTEGER) AS k,
       e.props->>'label' AS label,
       TRY_CAST(e.props->>'score' AS DOUBLE) AS score,
       c.c_name AS customer_name
FROM events e LEFT JOIN customer c ON c.c_custkey = TRY_CAST(e.props->>'k' AS INTEGER)
"""

ORACLE["unpack_view_core"] = """
SELECT e.event_id, e.user_id, e.ts, e.event_type, e.value,
       TRY_CAST(e.props->>'k' AS INTEGER) AS k, c.c_name AS customer_name
FROM events e LEFT JOIN customer c ON c.c_custkey = TRY_CAST(e.props->>'k' AS INTEGER)
"""

ORACLE["pack_json"] = """
SELECT c_custkey,
       to_json(struct_pack(c_name := c_name, c_nationkey := c_nationkey,
                           c_acctbal := c_acctbal, c_mktsegment := c_mktsegment))::VARCHAR AS data
FROM customer
"""

_UPSERT_T = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
_UPSERT_B = "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"
_ACTION_FULL = """
       CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN 'update'
            WHEN s.o_orderkey IS NOT NULL THEN 'insert' ELSE 'keep' END AS merge_action"""

ORACLE["upsert"] = f"""
WITH t AS ({_UPSERT_T}),
     s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice,
                  o_orderdate, o_orderpriority FROM ({_UPSERT_B}))
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
{_ACTION_FULL}
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""

ORACLE["upsert_partial"] = f"""
WITH t AS ({_UPSERT_T}),
     s AS (SELECT o_orderkey,
                  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE lower(o_orderstatus) END AS o_orderstatus
           FROM ({_UPSERT_B}))
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       t.o_totalprice, t.o_orderdate, t.o_orderpriority,
{_ACTION_FULL}
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""

ORACLE["upsert_insert_only"] = f"""
WITH t AS ({_UPSERT_T}),
     s AS (SELECT o_orderkey FROM ({_UPSERT_B}))
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority,
       CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NULL THEN 'insert' ELSE 'keep' END AS merge_action
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
"""

ORACLE["upsert_counts"] = f"""
WITH t AS ({_UPSERT_T}), s AS ({_UPSERT_B}),
     j AS (SELECT t.o_orderkey AS tk, s.o_orderkey AS sk FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey)
SELECT COUNT(*) FILTER (WHERE sk IS NOT NULL AND tk IS NULL) AS n_inserted,
       COUNT(*) FILTER (WHERE sk IS NOT NULL AND tk IS NOT NULL) AS n_updated,
       COUNT(*) FILTER (WHERE sk IS NOT NULL) AS n_affected,
       COUNT(*) AS n_rows
FROM j
"""

ORACLE["many_to_many"] = """
SELECT s.s_suppkey, s.s_nationkey, p.n_nationkey AS peer_nationkey
FROM supplier s
JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN nation p ON p.n_regionkey = n.n_regionkey
"""

ORACLE["array_cond_count"] = """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n_dims,
       CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS n_positive
FROM embeddings
"""

ORACLE["array_flatten_first"] = """
WITH w AS (SELECT doc_id,
                  flatten(list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' '))) AS words
           FROM documents)
SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, words[1] AS first_word FROM w
"""

ORACLE["first_per_group"] = """
SELECT user_id, event_type, event_id, ts, value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
      FROM events)
WHERE rn = 1
"""

ORACLE["group_min_flag"] = """
SELECT event_id, user_id, ts,
       CASE WHEN ts = MIN(ts) OVER (PARTITION BY user_id) THEN value END AS first_value
FROM events
"""

ORACLE["lag_zero"] = """
SELECT event_id, user_id, ts, value,
       COALESCE(LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS prev_value
FROM events
"""

ORACLE["locf_zero"] = """
SELECT event_id, user_id, ts, event_type,
       COALESCE(LAST_VALUE(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
                  PARTITION BY user_id ORDER BY ts, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS last_purchase_value
FROM events
"""

ORACLE["pivot_wide"] = """
SELECT user_id,
  first(value ORDER BY ts, event_id) FILTER (WHERE event_type = 'view') AS first_view,
  first(value ORDER BY ts, event_id) FILTER (WHERE event_type = 'signup') AS first_signup,
  first(value ORDER BY ts, event_id) FILTER (WHERE event_type = 'purchase') AS first_purchase,
  first(value ORDER BY ts, event_id) FILTER (WHERE event_type = 'error') AS first_error,
  first(value ORDER BY ts, event_id) FILTER (WHERE event_type = 'click') AS first_click
FROM events GROUP BY user_id
"""

ORACLE["lineup_fill"] = """
WITH a AS (
  SELECT event_id, user_id, ts,
         CASE WHEN ts = MIN(ts) OVER (PARTITION BY user_id) THEN value END AS start_value,
         CASE WHEN event_type = 'purchase' THEN value END AS sub_value
  FROM events)
SELECT event_id, user_id, ts,
       LAST_VALUE(COALESCE(start_value, sub_value) IGNORE NULLS) OVER (
         PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled_value
FROM a
"""

ORACLE["date_chunks"] = """
WITH r AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS s, CAST(MAX(o_orderdate) AS DATE) AS e FROM orders),
     g AS (SELECT e, unnest(generate_series(s, e, INTERVAL 7 DAY)) AS d FROM r)
SELECT CAST(d AS DATE) AS chunk_start, LEAST(CAST(d AS DATE) + 6, e) AS chunk_end FROM g
"""

ORACLE["work_plan"] = """
WITH r AS (SELECT o_orderstatus AS data_source, CAST(MIN(o_orderdate) AS DATE) AS s,
                  CAST(MAX(o_orderdate) AS DATE) AS e
           FROM orders GROUP BY o_orderstatus),
     g AS (SELECT data_source, e, unnest(generate_series(s, e, INTERVAL 2 DAY)) AS d FROM r),
     u AS (SELECT data_source, CAST(d AS DATE) AS date_start, LEAST(CAST(d AS DATE) + 1, e) AS date_end FROM g)
SELECT data_source, date_start, date_end
FROM u
WHERE NOT EXISTS (
  SELECT 1 FROM orders o
  WHERE o.o_orderstatus = u.data_source
    AND CAST(o.o_orderdate AS DATE) BETWEEN u.date_start AND u.date_end)
"""

_LATEST = """
SELECT user_id, event_id, ts, event_type AS status, value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
"""

ORACLE["ledger_latest"] = _LATEST

ORACLE["ledger_get"] = f"""
SELECT * FROM events
WHERE event_id IN (SELECT event_id FROM ({_LATEST}) WHERE status = 'error')
"""

ORACLE["scalar_strings"] = """
SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words,
       array_to_string(string_split(p_name, ' '), ',') AS name_csv,
       string_split(p_name, ' ')[1] AS first_word
FROM part
"""

ORACLE["scalar_arrays"] = """
SELECT p_partkey,
       CAST(len(list_distinct(list_filter(string_split(p_name, ' '),
                                          lambda w: NOT list_contains(['ring', 'bolt'], w)))) AS INTEGER)
         AS n_other_words,
       list_contains(string_split(p_name, ' '), 'ring') AS has_ring
FROM part
"""

ORACLE["coverage_alarm"] = """
SELECT a.lang, a.n_docs, b.n_labels,
       ROUND(100.0::DOUBLE * b.n_labels / NULLIF(a.n_docs, 0), 1) AS label_coverage_pct,
       ROUND(100.0::DOUBLE * b.n_labels / NULLIF(a.n_docs, 0), 1) < 90.0 AS below_alarm
FROM (SELECT lang, COUNT(*) AS n_docs FROM documents GROUP BY lang) a
LEFT JOIN (SELECT d.lang, COUNT(*) AS n_labels
           FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY d.lang) b
USING (lang)
"""

ORACLE["uncovered_days"] = """
WITH r AS (SELECT o_orderstatus AS data_source, CAST(MIN(o_orderdate) AS DATE) AS s,
                  CAST(MAX(o_orderdate) AS DATE) AS e
           FROM orders GROUP BY o_orderstatus),
     g AS (SELECT data_source, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM r)
SELECT data_source, day FROM g
WHERE NOT EXISTS (SELECT 1 FROM orders o
                  WHERE o.o_orderstatus = g.data_source AND CAST(o.o_orderdate AS DATE) = g.day)
"""

ORACLE["unpack_view_variant"] = ORACLE["unpack_view"]

ORACLE["dedupe_last"] = """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
      FROM lineitem)
WHERE rn = 1
"""

ORACLE["stale_runs"] = """
SELECT user_id, event_id, ts, event_type AS status, value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type = 'view' AND ts < TIMESTAMP '2024-01-30 12:00:00'
"""

ORACLE["materialized_view"] = """
SELECT e.event_type, CAST(e.ts AS DATE) AS day, COUNT(*) AS n, COUNT(c.c_name) AS named,
       CAST(SUM(TRY_CAST(e.props->>'k' AS INTEGER)) AS BIGINT) AS sum_k
FROM events e LEFT JOIN customer c ON c.c_custkey = TRY_CAST(e.props->>'k' AS INTEGER)
GROUP BY 1, 2
"""

ORACLE["upsert_partition_move"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
       CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1997-01-01' THEN 'M' ELSE o_orderstatus END AS status,
       CAST(year(o_orderdate) + CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1997-01-01' THEN 1 ELSE 0 END AS INTEGER) AS part_year
FROM orders
"""

ORACLE |= GAME_SQL | STORAGE_SQL
