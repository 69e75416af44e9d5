"""Oracles of the relational query shapes (the plain textbook form)."""

_LEFT = ("SELECT c_custkey, c_name, count(o_orderkey) AS order_count FROM customer {j} JOIN "
         "(SELECT * FROM orders WHERE o_totalprice > 400000) o ON c_custkey = o_custkey GROUP BY c_custkey, c_name")
_GOLD = ("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT' "
         "GROUP BY o_orderpriority")
_ALL = "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority"


def _diff(wrong, right):
    return (f"SELECT *, 'missing' AS side, count(*) AS copies FROM (({right}) EXCEPT ALL ({wrong})) GROUP BY ALL UNION ALL "
            f"SELECT *, 'extra' AS side, count(*) AS copies FROM (({wrong}) EXCEPT ALL ({right})) GROUP BY ALL")


EVENT = "event_id, user_id, event_type, value"

ORACLE = {
    "A1_projection_filter": "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'",
    "A2_point_lookup": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey = 101",
    "A3_string_filter": "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_type = 'ECONOMY'",
    "A4_sort_desc": "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey",
    "A5_group_count": _ALL,
    "A6_left_join_count": "SELECT c_custkey, c_name, count(o_orderkey) AS order_count FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name",
    "A7_three_way_join": "SELECT o_orderkey, l_linenumber, p_partkey, o_totalprice, p_name FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey",
    "A8_having": "SELECT c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_acctbal FROM customer GROUP BY c_nationkey HAVING CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) > 4500",
    "A9_above_group_mean": "SELECT c_custkey, c_name, c_acctbal FROM customer e WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer x WHERE x.c_nationkey = e.c_nationkey)",
    "A10_count_distinct": "SELECT count(DISTINCT l_orderkey) AS n_orders FROM lineitem WHERE l_returnflag = 'R'",
    "A11_join_instead_of_subqueries": """SELECT c_custkey, c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS order_count,
        CAST(coalesce((SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders WHERE o_custkey = c_custkey), 0) AS DOUBLE) AS total_spent FROM customer""",
    "A12_date_range": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3",
    "A13_explicit_join": "SELECT c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 300000",
    "A14_narrow_projection": """SELECT o_orderkey, o_totalprice, o_orderstatus, c_name AS customer_name, c_acctbal, n_name AS nation_name
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'P'""",
    "A15_top_three_per_group": """SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (SELECT o_custkey, o_orderkey, o_totalprice,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) r WHERE rank <= 3""",
    "A16_buggy_versus_fixed": _diff(_LEFT.format(j="INNER"), _LEFT.format(j="LEFT")),
    "A17_golden_output": _diff(_ALL, _GOLD),
    "B1_equality": "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 3",
    "B2_two_equalities": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'",
    "B3_like": "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_name LIKE '%ring%'",
    "B4_equality_open_range": f"SELECT {EVENT} FROM events WHERE event_type = 'click' AND ts > TIMESTAMP '2024-01-20 00:00:00'",
    "B5_two_equalities_range": f"SELECT {EVENT} FROM events WHERE user_id = 7 AND event_type = 'view' AND ts > TIMESTAMP '2024-01-05 00:00:00'",
    "B6_two_equalities_between": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-06-30'",
    "B7_filter_sort": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate, o_orderkey",
    "B8_not_equal_sort": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_custkey = 77 AND o_orderstatus <> 'F' ORDER BY o_orderdate, o_orderkey",
    "B9_latest_k": f"SELECT {EVENT} FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 50",
    "B10_range_sort_desc": f"SELECT {EVENT} FROM events WHERE event_type = 'signup' AND ts > TIMESTAMP '2024-01-20 00:00:00' ORDER BY ts DESC, event_id DESC",
    "B11_join_count": "SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7",
    "B12_filter_group_count": "SELECT user_id, count(*) AS open_count FROM events WHERE event_type = 'error' GROUP BY user_id",
    "B13_big_orders_per_customer": "SELECT c_custkey, c_name, count(o_orderkey) AS order_count FROM customer, orders WHERE c_custkey = o_custkey AND o_totalprice > 200000 GROUP BY c_custkey, c_name",
    "B14_returned_lines_per_supplier": "SELECT s_suppkey, s_name, count(*) AS n_lines FROM supplier, lineitem WHERE s_suppkey = l_suppkey AND l_returnflag = 'R' GROUP BY s_suppkey, s_name",
    "B15_quantity_per_part": "SELECT p_partkey, p_name, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM part, lineitem WHERE p_partkey = l_partkey GROUP BY p_partkey, p_name",
    "B16_flag_count": "SELECT quality, count(*) AS n FROM labels WHERE toxic = 0 GROUP BY quality",
    "B17_spend_rewrite": "SELECT c_custkey, c_name, count(o_orderkey) AS order_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM customer, orders WHERE c_custkey = o_custkey AND o_orderstatus = 'O' GROUP BY c_custkey, c_name",
    "B18_semi_join": "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
    "B19_anti_join": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
}
