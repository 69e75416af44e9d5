"""Statement analysis on statements that mislead a search for words."""

import pytest
from pyspark.sql import functions as F

from tunewright.operators import metrics, statements, workload

COLUMNS = [("t", "a"), ("t", "b"), ("t", "c"), ("u", "a"), ("u", "d"), ("v", "e"), ("v", "day")]

PREDICATES = {
    "SELECT a FROM t WHERE a = 1 AND b > 2 AND c BETWEEN 3 AND 4": {("t", "a", "=", "filter", False), ("t", "b", ">", "filter", False), ("t", "c", "BETWEEN", "filter", False)},
    "select x.a from t as x where x.a in (1, 2) and x.b like 'k%' and x.c not in (5)": {
        ("t", "a", "IN", "filter", False), ("t", "b", "LIKE", "filter", False), ("t", "c", "NOT IN", "filter", False)},
    "SELECT 1 FROM t WHERE b LIKE '%k' AND 7 <= c AND a IS NOT NULL": {("t", "b", "LIKE %", "filter", False), ("t", "c", ">=", "filter", False), ("t", "a", "IS", "filter", False)},
    # comments, strings and quoted names
    "SELECT 'x WHERE b = 1' FROM t -- WHERE c = 2\nWHERE /* b = 3 AND */ \"a\" = 'it''s; WHERE b = 1'": {("t", "a", "=", "filter", False)},
    "SELECT a FROM `t` WHERE `t`.`b` < 5": {("t", "b", "<", "filter", False)},
    # OR at any depth, on one side and not on the other
    "SELECT a FROM t WHERE (a = 1 OR (b = 2)) AND c = 3": {("t", "a", "=", "filter", True), ("t", "b", "=", "filter", True), ("t", "c", "=", "filter", False)},
    "SELECT a FROM t WHERE a = 1 OR b = 2": {("t", "a", "=", "filter", True), ("t", "b", "=", "filter", True)},
    # joins, with and without ON; the side without alias is found by its column
    "SELECT t.a FROM t JOIN u ON t.a = u.a WHERE d = 4": {("t", "a", "=", "join", False), ("u", "a", "=", "join", False), ("u", "d", "=", "filter", False)},
    "SELECT p.a FROM t p, u q WHERE p.a = q.a AND p.b <> 1": {("t", "a", "=", "join", False), ("u", "a", "=", "join", False), ("t", "b", "<>", "filter", False)},
    # nested queries: inner names first, then those around; the same alias twice
    "SELECT a FROM t WHERE b = (SELECT max(d) FROM u WHERE u.a = t.a AND d > 3) AND c = 1": {
        ("t", "b", "=", "filter", False), ("u", "a", "=", "join", False), ("t", "a", "=", "join", False), ("u", "d", ">", "filter", False), ("t", "c", "=", "filter", False)},
    "SELECT a FROM t x WHERE EXISTS (SELECT 1 FROM v x WHERE x.e = 1) AND x.c = 2": {("v", "e", "=", "filter", False), ("t", "c", "=", "filter", False)},
    "WITH w AS (SELECT e FROM v WHERE day >= DATE '2020-01-01') SELECT a FROM t JOIN w ON t.a = w.e WHERE t.c = 0": {
        ("v", "day", ">=", "filter", False), ("t", "a", "=", "join", False), ("t", "c", "=", "filter", False)},
    # no predicate columns: inside calls, unknown names, no filter at all
    "SELECT a FROM t WHERE abs(a) = 1 AND extract(year FROM c) = 3 AND zz = 9": set(),
    "SELECT a FROM t": set(),
    "": set(),
    "SELECT ((((": set(),
    "SELECT a FROM t GROUP BY a HAVING a > 3 ORDER BY b": {("t", "a", ">", "filter", False)},
}
FLAGS = {
    "SELECT * FROM t": {"select_star"}, "SELECT DISTINCT x.* FROM t x": {"select_star"}, "SELECT count(*) FROM t": set(), "SELECT a * b FROM t": set(),
    "SELECT 'SELECT *' FROM t -- SELECT *": set(),
    "SELECT a FROM t WHERE upper(b) = 'X'": {"function_on_column"}, "SELECT a FROM t WHERE b = upper('x') AND c IN (1, 2)": set(),
    "SELECT a FROM t WHERE (b = 1 OR c = 2)": set(),
    "SELECT t.a FROM t, u": {"comma_join"}, "SELECT t.a FROM t, u WHERE t.a = u.a": set(), "SELECT t.a FROM t, u WHERE t.a = 5": {"comma_join"},
    "SELECT a FROM t WHERE a IN (SELECT u.a FROM u, v)": {"comma_join"},
    "SELECT a, (SELECT max(d) FROM u) FROM t": {"scalar_subquery"}, "SELECT a FROM (SELECT a FROM t) s": set(),
    "SELECT a FROM t WHERE sum(b) > 1": {"aggregate_in_where"}, "SELECT a FROM t WHERE b > (SELECT avg(b) FROM t)": set(), "SELECT a FROM t HAVING sum(b) > 1": set(),
    "SELECT rank() OVER () FROM t": {"window_without_order"}, "SELECT rank() OVER (ORDER BY a) FROM t": set(),
}


def test_predicates(spark):
    given = spark.createDataFrame([(f"k{k}", sql) for k, sql in enumerate(PREDICATES)], "template string, sql string")
    known = spark.createDataFrame(COLUMNS, "table_name string, column string")
    found = {}
    for r in statements.predicates(given, known).collect():
        found.setdefault(r["template"], set()).add((r["table_name"], r["column"], r["op"], r["kind"], r["either"]))
    for k, (sql, want) in enumerate(PREDICATES.items()):
        assert found.get(f"k{k}", set()) == want, sql


def test_mistakes(spark):
    given = spark.createDataFrame([(f"k{k}", sql) for k, sql in enumerate(FLAGS)], "template string, sql string")
    found = {}
    for r in statements.mistakes(given).collect():
        found.setdefault(r["template"], set()).add(r["flag"])
    for k, (sql, want) in enumerate(FLAGS.items()):
        assert found.get(f"k{k}", set()) == want, sql


@pytest.mark.parametrize("cols, point, span, want", [
    (("a", "b"), ("a", "b"), (), 2), (("a", "b"), ("b",), (), 0), (("a", "b", "c"), ("a",), ("b",), 2), (("a", "b", "c"), ("a", "c"), ("b",), 2), (("a",), (), (), 0)])
def test_leading_columns(spark, cols, point, span, want):
    array = lambda v: F.array(*map(F.lit, v)).cast("array<string>")
    assert spark.range(1).select(workload.looked_up(array(cols), array(point), array(span))).first()[0] == want


def test_used_layouts_are_not_offered(spark, sf):
    unused = {tuple(r) for r in workload.unused_layouts(spark, sf).collect()}
    assert unused == {("lineitem", "by_l_suppkey"), ("part", "by_p_brand")}  # by_ts serves ts >= ..., by_l_shipdate_... BETWEEN


def test_large_amounts(spark, sf, tmp_path):
    """Latencies far beyond 10^10 in all."""
    spark.read.parquet(f"{sf}/events.parquet").withColumn("value", F.when(F.col("event_id") % 7 == 0, 1e-9).otherwise(F.col("value") * 1e7)).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("customer", "orders", "lineitem", "part", "nation"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    shares = workload.time_shares(spark, str(tmp_path)).collect()
    assert max(r["total_ms"] for r in shares) > 1e10 and abs(sum(r["time_share"] for r in shares) - 1) < 1e-3
    assert 0 < workload.workload_score(spark, str(tmp_path)).first()["served_share"] < 1
    assert max(r["max_ms"] for r in workload.latency_profile(spark, str(tmp_path)).collect()) > 1e9
    assert metrics.change(spark, str(tmp_path)).count() == 5
