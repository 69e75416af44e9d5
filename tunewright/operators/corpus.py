"""Relational query shapes: the corrected queries and the slow-query shapes.

Aggregates that follow a join on the same key are computed before the join, so
that a key holding a large share of the fact table is reduced map-side and the
join sees one row per key.  Row-level joins rely on AQE skew splitting.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright.session import table

MONEY = "decimal(18,2)"


def _t(name):
    return lambda spark, sf_dir: table(spark, sf_dir, name)


customer, orders, lineitem, part = _t("customer"), _t("orders"), _t("lineitem"), _t("part")
supplier, nation, region, events = _t("supplier"), _t("nation"), _t("region"), _t("events")
labels = _t("labels")


def order_totals(spark, sf_dir, predicate=None):
    """Orders and spend per customer, reduced before any join."""
    o = orders(spark, sf_dir)
    if predicate is not None:
        o = o.where(predicate)
    return o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("spent"))


# ------------------------------------------------- corrected queries

def projection_filter(spark, sf_dir):
    return customer(spark, sf_dir).where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", "c_acctbal")


def point_lookup(spark, sf_dir):
    return orders(spark, sf_dir).where("o_orderkey = 101").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def string_filter(spark, sf_dir):
    return part(spark, sf_dir).where("p_type = 'ECONOMY'").select("p_partkey", "p_name", "p_retailprice")


def sort_desc(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", "p_name", "p_retailprice").orderBy(
        F.desc("p_retailprice"), "p_partkey")


def group_count(spark, sf_dir):
    return orders(spark, sf_dir).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


def left_join_count(spark, sf_dir):
    """Customers with their order count; customers without orders show 0."""
    return (customer(spark, sf_dir).select("c_custkey", "c_name")
            .join(order_totals(spark, sf_dir), F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "c_name", F.coalesce("order_count", F.lit(0)).alias("order_count")))


def three_way_join(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    li = lineitem(spark, sf_dir).select("l_orderkey", "l_partkey", "l_linenumber")
    p = part(spark, sf_dir).select("p_partkey", "p_name")
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            .select("o_orderkey", "l_linenumber", "p_partkey", "o_totalprice", "p_name"))


def having(spark, sf_dir):
    per = customer(spark, sf_dir).groupBy("c_nationkey").agg(
        (F.sum(F.col("c_acctbal").cast(MONEY)).cast("double") / F.count(F.lit(1))).alias("avg_acctbal"))
    return per.where("avg_acctbal > 4500")


def above_group_mean(spark, sf_dir):
    """Rows above the mean of their group.

    The means are one row per nation (a fixed dimension), so they are broadcast
    and the customers stay where they are, however large one nation is.
    """
    c = customer(spark, sf_dir).select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    mean = c.groupBy(F.col("c_nationkey").alias("nk")).agg(
        (F.sum(F.col("c_acctbal").cast(MONEY)).cast("double") / F.count(F.lit(1))).alias("mean"))
    return (c.join(F.broadcast(mean), c.c_nationkey == mean.nk).where(F.col("c_acctbal") > F.col("mean"))
            .select("c_custkey", "c_name", "c_acctbal"))


def count_distinct(spark, sf_dir):
    return lineitem(spark, sf_dir).where("l_returnflag = 'R'").agg(
        F.count_distinct("l_orderkey").alias("n_orders"))


def join_instead_of_subqueries(spark, sf_dir):
    return (customer(spark, sf_dir).select("c_custkey", "c_name")
            .join(order_totals(spark, sf_dir), F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "c_name", F.coalesce("order_count", F.lit(0)).alias("order_count"),
                    F.coalesce("spent", F.lit(0)).cast("double").alias("total_spent")))


def date_range(spark, sf_dir):
    """Half-open range instead of YEAR()/MONTH(): reaches the Parquet filter."""
    return (orders(spark, sf_dir)
            .where("o_orderdate >= timestamp_ntz'1997-03-01' AND o_orderdate < timestamp_ntz'1997-04-01'")
            .select("o_orderkey", "o_custkey", "o_totalprice"))


def explicit_join(spark, sf_dir):
    o = orders(spark, sf_dir).where("o_totalprice > 300000").select("o_orderkey", "o_custkey", "o_totalprice")
    c = customer(spark, sf_dir).select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey).select("c_name", "o_orderkey", "o_totalprice")


def narrow_projection(spark, sf_dir):
    o = orders(spark, sf_dir).where("o_orderstatus = 'P'").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey")
    c = customer(spark, sf_dir).select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    n = nation(spark, sf_dir).select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("c_name").alias("customer_name"),
                    "c_acctbal", F.col("n_name").alias("nation_name")))


def top_three(spark, sf_dir):
    """Top three orders per customer; WindowGroupLimit trims map-side."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return (orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_totalprice")
            .withColumn("rank", F.row_number().over(w)).where("rank <= 3"))


def result_diff(wrong, right):
    """Rows that only one of two results has, their side and how many copies.

    Signed counts per distinct row: one shuffle, copies combined map-side.
    """
    both = (right.withColumn("sign", F.lit(1).cast("bigint"))
            .unionByName(wrong.withColumn("sign", F.lit(-1).cast("bigint"))))
    net = both.groupBy(*right.columns).agg(F.sum("sign").alias("net")).where("net <> 0")
    return net.select(*right.columns, F.when(F.col("net") > 0, "missing").otherwise("extra").alias("side"),
                      F.abs("net").alias("copies"))


def buggy_versus_fixed(spark, sf_dir):
    """Inner join drops customers without orders over 400000; left join keeps them."""
    big = order_totals(spark, sf_dir, "o_totalprice > 400000")
    c = customer(spark, sf_dir).select("c_custkey", "c_name")
    on = F.col("c_custkey") == F.col("o_custkey")
    columns = ["c_custkey", "c_name", F.coalesce("order_count", F.lit(0)).alias("order_count")]
    return result_diff(c.join(big, on, "inner").select(*columns), c.join(big, on, "left").select(*columns))


GOLDEN_SCHEMA = "struct<o_orderpriority:string,n:bigint>"


def golden_compare(actual, golden_json, schema):
    """Compare a result with its expected rows, given as a JSON text column."""
    rows = golden_json.select(F.from_json("expected", schema).alias("r")).select("r.*")
    return result_diff(actual.select(*rows.columns), rows)


def golden_output(spark, sf_dir):
    """Counts per priority against a JSON rendering that lost the pending orders."""
    actual = group_count(spark, sf_dir)
    expected = (orders(spark, sf_dir).where("o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT'")
                .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
                .select(F.to_json(F.struct("o_orderpriority", "n")).alias("expected")))
    return golden_compare(actual, expected, GOLDEN_SCHEMA)


# ------------------------------------------------- slow-query shapes

def _where(source, predicate, *columns, order=()):
    def run(spark, sf_dir):
        df = source(spark, sf_dir).where(predicate)
        return (df.orderBy(*order) if order else df).select(*columns)
    return run


EVENT = ("event_id", "user_id", "event_type", "value")
NOW = "timestamp_ntz'2024-01-20 00:00:00'"


def join_count(spark, sf_dir):
    per = orders(spark, sf_dir).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = customer(spark, sf_dir).where("c_nationkey = 7").select("c_custkey")
    return c.join(per, c.c_custkey == per.o_custkey).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def filter_group_count(spark, sf_dir):
    return events(spark, sf_dir).where("event_type = 'error'").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("open_count"))


def big_orders_per_customer(spark, sf_dir):
    per = order_totals(spark, sf_dir, "o_totalprice > 200000").select("o_custkey", "order_count")
    c = customer(spark, sf_dir).select("c_custkey", "c_name")
    return c.join(per, c.c_custkey == per.o_custkey).select("c_custkey", "c_name", "order_count")


def returned_lines_per_supplier(spark, sf_dir):
    per = lineitem(spark, sf_dir).where("l_returnflag = 'R'").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"))
    s = supplier(spark, sf_dir).select("s_suppkey", "s_name")
    return s.join(per, s.s_suppkey == per.l_suppkey).select("s_suppkey", "s_name", "n_lines")


def quantity_per_part(spark, sf_dir):
    per = lineitem(spark, sf_dir).groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("quantity"))
    p = part(spark, sf_dir).select("p_partkey", "p_name")
    return p.join(per, p.p_partkey == per.l_partkey).select("p_partkey", "p_name", "quantity")


def unread_per_user(spark, sf_dir):
    return labels(spark, sf_dir).where("toxic = 0").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


def spend_rewrite(spark, sf_dir):
    per = order_totals(spark, sf_dir, "o_orderstatus = 'O'")
    c = customer(spark, sf_dir).select("c_custkey", "c_name")
    return c.join(per, c.c_custkey == per.o_custkey).select(
        "c_custkey", "c_name", "order_count", F.col("spent").cast("double").alias("spent"))


def big_spenders(spark, sf_dir):
    """Keys with a large order, deduplicated map-side: the inner side of a semi or
    anti join cannot be split by AQE."""
    return orders(spark, sf_dir).where("o_totalprice > 400000").select("o_custkey").distinct()


def with_orders(spark, sf_dir):
    return customer(spark, sf_dir).select("c_custkey", "c_name").join(
        big_spenders(spark, sf_dir), F.col("c_custkey") == F.col("o_custkey"), "left_semi")


def without_orders(spark, sf_dir):
    return customer(spark, sf_dir).select("c_custkey", "c_name").join(
        big_spenders(spark, sf_dir), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


def latest_k(spark, sf_dir):
    return (events(spark, sf_dir).where("event_type = 'purchase'").select("ts", *EVENT)
            .orderBy(F.desc("ts"), F.desc("event_id")).limit(50).drop("ts"))


def range_sort_desc(spark, sf_dir):
    return (events(spark, sf_dir).where(f"event_type = 'signup' AND ts > {NOW}").select("ts", *EVENT)
            .orderBy(F.desc("ts"), F.desc("event_id")).drop("ts"))



QUERIES = {
    "A1_projection_filter": projection_filter,
    "A2_point_lookup": point_lookup,
    "A3_string_filter": string_filter,
    "A4_sort_desc": sort_desc,
    "A5_group_count": group_count,
    "A6_left_join_count": left_join_count,
    "A7_three_way_join": three_way_join,
    "A8_having": having,
    "A9_above_group_mean": above_group_mean,
    "A10_count_distinct": count_distinct,
    "A11_join_instead_of_subqueries": join_instead_of_subqueries,
    "A12_date_range": date_range,
    "A13_explicit_join": explicit_join,
    "A14_narrow_projection": narrow_projection,
    "A15_top_three_per_group": top_three,
    "A16_buggy_versus_fixed": buggy_versus_fixed,
    "A17_golden_output": golden_output,
    "B1_equality": _where(customer, "c_nationkey = 3", "c_custkey", "c_name"),
    "B2_two_equalities": _where(lineitem, "l_returnflag = 'R' AND l_linestatus = 'O'",
                                "l_orderkey", "l_linenumber", "l_quantity"),
    "B3_like": _where(part, "p_name LIKE '%ring%'", "p_partkey", "p_name", "p_retailprice"),
    "B4_equality_open_range": _where(events, f"event_type = 'click' AND ts > {NOW}", *EVENT),
    "B5_two_equalities_range": _where(events, f"user_id = 7 AND event_type = 'view' AND ts > timestamp_ntz'2024-01-05 00:00:00'", *EVENT),
    "B6_two_equalities_between": _where(
        lineitem, "l_returnflag = 'A' AND l_linestatus = 'F' AND l_shipdate BETWEEN timestamp_ntz'1998-01-01' AND timestamp_ntz'1998-06-30'",
        "l_orderkey", "l_linenumber", "l_extendedprice"),
    "B7_filter_sort": _where(orders, "o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'",
                             "o_orderkey", "o_totalprice", order=("o_orderdate", "o_orderkey")),
    "B8_not_equal_sort": _where(orders, "o_custkey = 77 AND o_orderstatus <> 'F'",
                                "o_orderkey", "o_orderstatus", "o_totalprice", order=("o_orderdate", "o_orderkey")),
    "B9_latest_k": latest_k,
    "B10_range_sort_desc": range_sort_desc,
    "B11_join_count": join_count,
    "B12_filter_group_count": filter_group_count,
    "B13_big_orders_per_customer": big_orders_per_customer,
    "B14_returned_lines_per_supplier": returned_lines_per_supplier,
    "B15_quantity_per_part": quantity_per_part,
    "B16_flag_count": unread_per_user,
    "B17_spend_rewrite": spend_rewrite,
    "B18_semi_join": with_orders,
    "B19_anti_join": without_orders,
}
