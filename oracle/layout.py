"""Oracles of the dataset round trips and layout jobs."""

from oracle import ledger

_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
_END = """SELECT episode_id, max(step_no) + 1 AS line_no, '[END] success=' || CASE WHEN any_value(sc) >= 0.5 THEN 'true' ELSE 'false' END || ' steps=' || max(step_no)
   || ' score=' || printf('%.3f', CAST(round(any_value(sc), 3) AS DOUBLE)) || ' rewards=' || string_agg(printf('%.2f', CAST(round(reward, 2) AS DOUBLE)), ',' ORDER BY step_no) AS line
   FROM (SELECT *, greatest(0, least(1, round(sum(reward) OVER (PARTITION BY episode_id) * 0.1, 4))) AS sc FROM live) GROUP BY episode_id"""

ORACLE = {
    "IO1_json_array": "SELECT n_nationkey, n_name, n_regionkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation",
    "IO2_tagged_union": """SELECT p_partkey AS id, p_name AS name, p_brand AS brand, NULL::DOUBLE AS balance, 'easy' AS tier, 1 AS ord FROM part
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, 'hard', 2 FROM supplier""",
    "IO3_tolerant_read": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1",
    "IO4_flatten": """SELECT CAST(pos - 1 AS INTEGER) AS pos, count(*) AS n, CAST(sum(CAST(CAST(x AS DOUBLE) AS DECIMAL(18,8))) AS DOUBLE) AS total
        FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1""",
    "IO5_json_lines": "SELECT conv_id, turn, role, md5(text) AS digest FROM conversations",
    "IO6_json_documents": "SELECT * FROM part",
    "IO7_training_log": "SELECT doc_id AS step, CAST(quality AS DOUBLE) AS loss FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
    "IO8_run_log": f"""{ledger.CHAIN}
        SELECT episode_id, 0 AS line_no, '[START] task=' || episode_id || ' env=tunewright model=replay' AS line FROM live WHERE step_no = 1
        UNION ALL SELECT episode_id, step_no, '[STEP] step=' || step_no || ' action=' || action_type || ' reward=' || printf('%.2f', CAST(round(reward, 2) AS DOUBLE))
            || ' done=' || CASE WHEN done THEN 'true' ELSE 'false' END || ' error=null' FROM live
        UNION ALL {_END}""",
    "IO9_parsed_run_log": f"{ledger.CHAIN} SELECT episode_id, step_no, action_type, CAST(round(reward, 2) AS DOUBLE) AS reward, done FROM live",
    "IO9_run_log_source": f"{ledger.CHAIN} SELECT episode_id, step_no, action_type, CAST(round(reward, 2) AS DOUBLE) AS reward, done FROM live",
    "IO9_run_log_stream": f"{ledger.CHAIN} SELECT episode_id, step_no, action_type, CAST(round(reward, 2) AS DOUBLE) AS reward, done FROM live",
    "L1_list_partitions": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'O'",
    "L1_range_partitions": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'",
    "L1_hash_partitions": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1",
    "L2_clustered_copy": "SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem WHERE l_suppkey = 42",
    "L2_bucketed_join": "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
    "L3_statistics": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, "
        f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders" for c in _COLS),
    "L3_approximate_statistics": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, true AS within_a_tenth, count(DISTINCT {c}) <= 100 AS few_values FROM orders" for c in _COLS),
    "L5_drop_copy": "SELECT count(*) AS copy_rows, count(*) AS base_rows, false AS copy_exists FROM orders",
    "L4_denormalised_column": "SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
    # every scan returns its whole table: the tables are in no order that a filter could use; two subqueries read the orders twice
    "L6_rewrite_effect": """WITH k AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM customer) AS c)
        SELECT 'subqueries_to_join' AS rewrite, 0::BIGINT AS different_rows, c > 0 AS same_result, 2 * o + c AS rows_read_slow, 3::BIGINT AS files_slow, o + c AS rows_read_fast, 2::BIGINT AS files_fast FROM k
        UNION ALL SELECT 'function_to_range', (SELECT count(*) FROM orders WHERE (year(o_orderdate) = 1997 AND month(o_orderdate) = 3)
            <> (o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01')), true, o, 1, o, 1 FROM k
        UNION ALL SELECT 'comma_to_join', 0, true, o + c, 2, o + c, 2 FROM k""",
    "L2_z_ordered_skipping": " UNION ALL ".join(
        f"SELECT '{name}' AS filter, count(*) AS n_rows, CAST(coalesce(sum(l_orderkey), 0) AS BIGINT) AS key_sum, true AS few_files FROM lineitem WHERE {where}" for name, where in (
            ("first", "l_shipdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-03-31'"), ("second", "l_suppkey = 42"), ("third", "l_quantity < 3"),
            ("both", "l_suppkey IN (3, 4, 5) AND l_shipdate >= TIMESTAMP '1998-06-01'"), ("none", "l_suppkey = -1"))),
    "L3_refreshed_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM orders"
        for c in (*_COLS, "o_totalprice")),
    "L3_cost_based_join": """SELECT n_name, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND n_regionkey = 1 GROUP BY 1, 2""",
}
