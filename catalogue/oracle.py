"""The registered queries as plain SQL, written independently of the library."""

_TOP_BY_SEGMENT = """
SELECT segment, name, total_revenue, rank FROM (
  SELECT segment, name, total_revenue,
         cast(row_number() OVER (PARTITION BY segment ORDER BY total_revenue DESC, name) AS integer) AS rank
  FROM (SELECT c_mktsegment AS segment, c_name AS name, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL)) WHERE rank <= 5
"""

_CUSTOMER_PERFORMANCE = """
SELECT c_name AS name, c_mktsegment AS segment, count(*) AS total_orders,
       cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue,
       cast(sum(o_totalprice) / count(*) AS decimal(38,6)) AS avg_order_value
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""

_DAILY_TREND = """
SELECT cast(o_orderdate AS date) AS order_date, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue,
       count(*) AS total_orders
FROM orders GROUP BY ALL
"""

_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

_DASHBOARD = """
WITH o AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
seg AS (SELECT c_mktsegment AS s, o_orderstatus AS t, sum(o_totalprice) AS r FROM o GROUP BY ALL),
day AS (SELECT cast(o_orderdate AS date) AS d, sum(o_totalprice) AS r, count(*) AS n FROM o GROUP BY ALL),
cus AS (SELECT c_name AS c, sum(o_totalprice) AS r FROM o GROUP BY ALL ORDER BY r DESC, c LIMIT 5)
SELECT cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue, count(*) AS total_orders,
       cast(sum(o_totalprice) / count(*) AS decimal(38,6)) AS avg_order_value,
       (SELECT string_agg(concat_ws('|', s, t, cast(r AS decimal(38,2))), chr(10) ORDER BY r DESC, s, t) FROM seg)
         AS segment_performance,
       (SELECT string_agg(concat_ws('|', d, cast(r AS decimal(38,2)), n), chr(10) ORDER BY r DESC, d) FROM day)
         AS daily_trend,
       (SELECT string_agg(concat_ws('|', c, cast(r AS decimal(38,2))), chr(10) ORDER BY r DESC, c) FROM cus)
         AS top_customers
FROM o
"""

_NEST_IN_GROUPS = """
WITH o AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey
           LEFT JOIN nation ON c_nationkey = n_nationkey),
st AS (SELECT n_name, o_orderstatus AS t, sum(o_totalprice) AS r, count(*) AS n FROM o GROUP BY ALL),
cu AS (SELECT n_name, c_name AS c, sum(o_totalprice) AS r FROM o WHERE o_totalprice >= 499000 GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY r DESC, c) AS k FROM cu)
SELECT g.n_name, g.total_orders,
       (SELECT string_agg(concat_ws('|', t, cast(r AS decimal(38,2)), n), chr(10) ORDER BY r DESC, t)
        FROM st WHERE st.n_name = g.n_name) AS status_breakdown,
       coalesce((SELECT string_agg(concat_ws('|', c, cast(r AS decimal(38,2))), chr(10) ORDER BY r DESC, c)
        FROM rk WHERE rk.n_name = g.n_name AND k <= 3), '') AS rich
FROM (SELECT n_name, count(*) AS total_orders FROM o GROUP BY ALL) g
"""

_ORDERS_RECORD = """
SELECT 'semlayer_orders' AS target_table, (SELECT count(*) FROM orders) AS row_count, column_name, column_type
FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
             ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string'))
     AS c(column_name, column_type)
"""

_VERDICTS = """
SELECT 'check_invalid' AS name, (SELECT count(*) FROM customer WHERE c_acctbal < 0) = 0 AS passed,
       cast(1 AS bigint) AS returned_rows
UNION ALL SELECT 'check_fail', (SELECT count(*) FROM orders WHERE o_custkey IS NULL) = 0, 1
UNION ALL SELECT 'check_both', (SELECT count(*) FROM customer WHERE c_acctbal < -1e9) = 0, 1
UNION ALL SELECT 'check_other_count', false, 1
UNION ALL SELECT 'check_rows', count(*) = 0, count(*) FROM orders WHERE o_totalprice < 0
UNION ALL SELECT 'check_unlabelled', count(*) = 0, count(*) FROM documents LEFT JOIN labels USING (doc_id)
          WHERE quality IS NULL
"""

_TOLD = """
       CASE WHEN kind = 'rows' THEN found ELSE cast(1 AS bigint) END AS returned_rows,
       CASE WHEN kind = 'rows' AND found = 0 THEN 'no rows came back'
            WHEN kind = 'rows' THEN concat(found, ' rows came back; there should be none')
            WHEN found = 0 THEN concat(kind, ' is 0, as it should be')
            ELSE concat(kind, ' is ', found, '; it should be 0') END AS description
"""

_SUITE = f"""
SELECT target, name, found = 0 AS passed, {_TOLD}
FROM (
  SELECT 'orders' AS target, 'check_null_customer' AS name, 'invalid_count' AS kind, count(*) AS found
  FROM orders WHERE o_custkey IS NULL
  UNION ALL SELECT 'orders', 'check_small_amount', 'invalid_count', count(*) FROM orders WHERE o_totalprice <= 5000
  UNION ALL SELECT 'orders', 'check_status', 'rows', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F', 'P')
  UNION ALL SELECT 'documents', 'check_labelled', 'invalid_count', count(*)
            FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL)
"""

_CHECK_VIEWS = f"""
SELECT 'order_report' AS target, name, found = 0 AS passed, {_TOLD}
FROM (
  SELECT 'check_parents' AS name, 'invalid_count' AS kind, count(*) AS found
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL
  UNION ALL SELECT 'check_cheap', 'fail_count', count(*) FROM orders WHERE o_totalprice < 20000 AND o_orderstatus = 'F'
  UNION ALL SELECT 'test_poor_customers', 'rows', count(DISTINCT c_name)
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < -900)
"""

_CHECK_ERROR = f"""
SELECT 'orders' AS target, name, found = 0 AS passed, {_TOLD}
FROM (
  SELECT 'check_small_amount' AS name, 'invalid_count' AS kind, count(*) AS found FROM orders WHERE o_totalprice <= 5000
  UNION ALL SELECT 'check_null_customer', 'invalid_count', count(*) FROM orders WHERE o_custkey IS NULL)
UNION ALL SELECT 'orders', 'check_raises', false, 0, 'could not run'
"""

_CLOSURE = """
WITH RECURSIVE edges AS (
  SELECT 'order:' || o_orderkey AS src, 'customer:' || o_custkey AS dst FROM orders
  UNION SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
  UNION SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation),
reach AS (
  SELECT src, dst FROM edges
  UNION SELECT reach.src, edges.dst FROM reach JOIN edges ON reach.dst = edges.src)
SELECT src, dst FROM reach
"""

ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "scan_csv": _CUSTOMER,
    "scan_tsv": _CUSTOMER,
    "scan_json": _CUSTOMER,
    "scan_csv_texts": "SELECT * FROM conversations",
    "scan_tsv_texts": "SELECT * FROM conversations",
    "scan_json_texts": "SELECT * FROM conversations",
    "scan_folder": "SELECT * FROM conversations",
    "scan_orc": _CUSTOMER,
    "catalog_table": """
        SELECT s_nationkey, count(*) AS suppliers, cast(sum(s_acctbal) AS decimal(38,2)) AS balance
        FROM supplier GROUP BY ALL""",
    "sql_source_select": "SELECT o_orderkey, o_totalprice FROM orders",
    "source_extend": """
        SELECT lang, count(*) AS documents, cast(sum(length(text)) AS bigint) AS total_len
        FROM documents GROUP BY ALL""",
    "primary_key_violations_lines": """
        SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "select_columns": "SELECT s_suppkey, s_name FROM supplier",
    "select_star": "SELECT r_regionkey, r_name, r_regionkey + 1 AS key_plus_one FROM region",
    "select_joined_field": """
        SELECT o_orderkey, c_name AS name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "select_joined_many": """
        SELECT o_orderkey, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "computed_dimension": """
        SELECT l_orderkey, l_linenumber, cast(l_extendedprice * (1 - l_discount) AS decimal(38,4)) AS net_price
        FROM lineitem""",
    "rename_dimension": "SELECT c_custkey, c_mktsegment AS segment FROM customer",
    "literal_dimension": "SELECT 'general' AS category, count(*) AS customers FROM customer",
    "concat_dimension": "SELECT p_partkey, p_brand || ' ' || p_type AS label FROM part",
    "cast_dimension": "SELECT cast(n_nationkey AS varchar) AS key_text, n_name FROM nation",
    "where_compare": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 300000",
    "where_null": """
        SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""",
    "global_aggregate": """
        SELECT count(*) AS total_orders, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue FROM orders""",
    "global_aggregate_of_nothing": """
        SELECT count(*) AS total_orders, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue,
               cast(sum(o_totalprice) / nullif(count(*), 0) AS decimal(38,6)) AS avg_order_value
        FROM orders WHERE o_totalprice < 0""",
    "sum_inline_expr": """
        SELECT l_returnflag, cast(sum(l_extendedprice * l_quantity) AS decimal(38,2)) AS worth
        FROM lineitem GROUP BY ALL""",
    "ratio_measure": """
        SELECT o_orderpriority AS priority, cast(sum(o_totalprice) / count(*) AS decimal(38,6)) AS avg_order_value
        FROM orders GROUP BY ALL""",
    "filtered_measure": """
        SELECT o_orderpriority AS priority, count(*) FILTER (WHERE o_totalprice >= 300000) AS high_value_orders
        FROM orders GROUP BY ALL""",
    "group_by_only": "SELECT DISTINCT c_mktsegment AS segment FROM customer",
    "group_by_join_one": """
        SELECT c_mktsegment AS segment, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "view_customer_performance": _CUSTOMER_PERFORMANCE,
    "view_daily_trend": _DAILY_TREND,
    "high_value_orders": """
        SELECT c_name AS name, o_orderpriority AS priority, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 300000 GROUP BY ALL""",
    "transitive_join": """
        SELECT r_name, cast(sum(l_extendedprice * (1 - l_discount)) AS decimal(38,0)) AS net_revenue
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "join_many_root_measure": """
        SELECT l_returnflag, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue, count(*) AS total_orders
        FROM (SELECT DISTINCT o_orderkey, o_totalprice, l_returnflag
              FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) GROUP BY ALL""",
    "join_many_root_filter": """
        SELECT o_orderpriority AS priority, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue,
               count(*) AS total_orders
        FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)
        GROUP BY ALL""",
    "join_many_spanning_filter": """
        SELECT o_orderpriority AS priority, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue,
               count(*) AS total_orders, cast(sum(n) AS bigint) AS lines
        FROM (SELECT o_orderkey, o_orderpriority, o_totalprice, count(*) AS n
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_extendedprice * 4 > o_totalprice
              GROUP BY ALL) GROUP BY ALL""",
    "join_many_computed_key": """
        SELECT ship_year, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue, count(*) AS total_orders
        FROM (SELECT DISTINCT o_orderkey, o_totalprice, cast(year(l_shipdate) AS integer) AS ship_year
              FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) GROUP BY ALL""",
    "join_many_filtered_measure": """
        SELECT o_orderpriority AS priority, count(*) AS total_orders,
               count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'))
                 AS returned_orders
        FROM orders GROUP BY ALL""",
    "join_many_child_measure": """
        SELECT o_orderpriority AS priority, cast(sum(l_quantity) AS decimal(38,2)) AS quantity,
               count(l_orderkey) AS lines
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
    "join_many_child_filter": """
        SELECT o_orderpriority AS priority, l_returnflag, cast(sum(l_quantity) AS decimal(38,2)) AS quantity,
               count(l_orderkey) AS lines
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
        WHERE l_quantity > 25 AND o_totalprice > 100000 GROUP BY ALL""",
    "join_many_mixed": """
        WITH j AS (SELECT * FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
        a AS (SELECT l_returnflag, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue
              FROM (SELECT DISTINCT o_orderkey, o_totalprice, l_returnflag FROM j) GROUP BY ALL),
        b AS (SELECT l_returnflag, count(l_orderkey) AS lines FROM j GROUP BY ALL)
        SELECT a.l_returnflag, total_revenue, lines
        FROM a JOIN b ON a.l_returnflag IS NOT DISTINCT FROM b.l_returnflag""",
    "join_two_many": """
        SELECT c_mktsegment AS segment, count(*) AS customers, cast(sum(o.r) AS decimal(38,2)) AS total_revenue,
               cast(sum(e.v) AS decimal(38,2)) AS event_value, cast(coalesce(sum(e.n), 0) AS bigint) AS events
        FROM customer
        LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS r FROM orders GROUP BY ALL) o ON c_custkey = o_custkey
        LEFT JOIN (SELECT user_id, sum(value) AS v, count(*) AS n FROM events GROUP BY ALL) e ON c_custkey = user_id
        GROUP BY ALL""",
    "join_many_to_many": """
        SELECT priority, count(event_id) AS events, cast(sum(value) AS decimal(38,2)) AS event_value
        FROM (SELECT DISTINCT o_orderpriority AS priority, event_id, value
              FROM orders LEFT JOIN events ON o_custkey = user_id) GROUP BY ALL""",
    "join_many_nested": """
        WITH c AS (SELECT c_nationkey AS k, count(*) AS customers, sum(c_acctbal) AS balance
                   FROM customer GROUP BY ALL),
        o AS (SELECT c_nationkey AS k, count(*) AS orders, sum(o_totalprice) AS revenue
              FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)
        SELECT r_name, n_name, cast(1 AS bigint) AS nations, coalesce(customers, 0) AS customers,
               cast(balance AS decimal(38,2)) AS balance, coalesce(orders, 0) AS total_orders,
               cast(revenue AS decimal(38,2)) AS total_revenue
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN c ON n_nationkey = c.k LEFT JOIN o ON n_nationkey = o.k""",
    "join_one_side_measure": """
        SELECT status, cast(sum(c_acctbal) AS decimal(38,2)) AS balance, count(c_custkey) AS customers
        FROM (SELECT DISTINCT o_orderstatus AS status, c_custkey, c_acctbal
              FROM orders LEFT JOIN customer ON o_custkey = c_custkey) GROUP BY ALL""",
    "join_one_side_order_value": """
        WITH a AS (SELECT l_returnflag, count(*) AS lines FROM lineitem GROUP BY ALL),
        b AS (SELECT l_returnflag, count(o_orderkey) AS total_orders,
                     cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue
              FROM (SELECT DISTINCT l_returnflag, o_orderkey, o_totalprice
                    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey) GROUP BY ALL)
        SELECT a.l_returnflag, lines, total_orders, total_revenue FROM a JOIN b USING (l_returnflag)""",
    "join_cross": """
        SELECT r_name, count(DISTINCT r_regionkey) AS regions, count(*) AS pairs
        FROM region CROSS JOIN nation GROUP BY ALL""",
    "join_cross_filtered": """
        SELECT r_name, count(DISTINCT r_regionkey) AS regions, count(*) AS pairs
        FROM region CROSS JOIN nation WHERE n_nationkey < 5 GROUP BY ALL""",
    "join_cross_nothing": """
        SELECT count(DISTINCT r_regionkey) AS regions, count(n_nationkey) AS pairs
        FROM region CROSS JOIN nation WHERE n_nationkey < 0""",
    "join_pruned": """
        SELECT o_orderpriority AS priority, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue,
               count(*) AS total_orders
        FROM orders GROUP BY ALL""",
    "two_stage_top_brands": """
        SELECT p_brand, cast(sum(l_extendedprice * (1 - l_discount)) AS decimal(38,0)) AS net_revenue
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL
        ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC NULLS LAST, p_brand LIMIT 5""",
    "stage_over_groups": """
        SELECT total_orders, count(*) AS customers
        FROM (SELECT o_custkey, count(*) AS total_orders FROM orders GROUP BY ALL) GROUP BY ALL""",
    "limited_view": """
        SELECT c_name AS name, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL
        ORDER BY total_revenue DESC NULLS LAST, name LIMIT 5""",
    "nest_named_flat": """
        SELECT c_mktsegment AS segment, o_orderstatus AS status,
               cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue, count(*) AS total_orders
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "nest_topk_flat": _TOP_BY_SEGMENT,
    "executive_dashboard_text": _DASHBOARD,
    "nest_in_groups": _NEST_IN_GROUPS,
    "materialized_table": _CUSTOMER_PERFORMANCE,
    "materialized_view": _DAILY_TREND,
    "materialized_sql_view": """
        SELECT o_orderstatus AS status, count(*) AS total_orders FROM orders GROUP BY ALL""",
    "materialized_record": _ORDERS_RECORD,
    "materialized_preview": """
        SELECT o_orderstatus AS status, cast(sum(o_totalprice) AS decimal(38,2)) AS total_revenue,
               count(*) AS total_orders FROM orders GROUP BY ALL""",
    "row_limit_select": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25""",
    "downstream_digest": """
        SELECT count(*) AS vip_count
        FROM (SELECT c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
              GROUP BY c_name, c_mktsegment HAVING cast(sum(o_totalprice) AS decimal(38,2)) > 2500000)""",
    "check_null_key": "SELECT count(*) AS invalid_count FROM orders WHERE o_custkey IS NULL",
    "check_positive_amount": "SELECT count(*) AS invalid_count FROM orders WHERE o_totalprice <= 0",
    "check_offending_rows": _CUSTOMER + " WHERE c_acctbal < 0",
    "check_verdicts": _VERDICTS,
    "check_error": _CHECK_ERROR,
    "check_suite": _SUITE,
    "check_views": _CHECK_VIEWS,
    "lineage_closure": _CLOSURE,
}
