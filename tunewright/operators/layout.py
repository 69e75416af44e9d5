"""Physical layout jobs: partitioned, clustered and bucketed copies, statistics."""

import uuid
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tunewright.operators.corpus import MONEY, result_diff
from tunewright.session import materialised, shared_dir, table


FILE_BYTES = 256 << 20


# A task sorts the rows of its file; they are many times larger in memory than compressed in a file.
SORT_BYTES = 256 << 20
SORTED_TOGETHER = 16


def row_bytes(df):
    """Bytes of all rows of df as a sort holds them: eight a column and what stands beside it, and a few a row."""
    beside = [F.octet_length(c) if isinstance(t, (StringType, BinaryType)) else F.octet_length(F.to_json(c))
              for c, t in ((F.col(f"`{f.name}`"), f.dataType) for f in df.schema) if isinstance(t, (StringType, BinaryType, ArrayType, MapType, StructType))]
    flat = 8 * len(df.columns) + SORTED_TOGETHER
    return df.agg(F.coalesce(F.sum(sum((F.coalesce(b, F.lit(0)) for b in beside), F.lit(flat)).cast("bigint")), F.lit(0))).first()[0]


def pieces(df, per_piece=FILE_BYTES, per_sort=SORT_BYTES):
    """Files or buckets for the rows of df: of about per_piece by the size that the optimiser reads off its files, and of per_sort in memory at most, about."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // per_piece), -(-row_bytes(df) // per_sort))


def partition_table(df, path, column, kind="LIST", files=None, tie=None):
    """Rewrite a table partitioned by a column.

    LIST   one folder per value; REBALANCE splits a value that holds much of the table
    RANGE  files of disjoint ranges; `tie` cuts a single huge value into several files
    HASH   files by hash of the column, split again when a hash bucket is too large
    """
    if kind == "LIST":
        return df.hint("rebalance", F.col(column)).write.partitionBy(column).parquet(path)
    if kind == "RANGE":
        keys = [column] + ([tie] if tie else [])
        return df.repartitionByRange(files or pieces(df), *keys).sortWithinPartitions(*keys).write.parquet(path)
    if kind == "HASH":
        return df.hint("rebalance", files or pieces(df), F.col(column)).write.parquet(path)
    raise ValueError(f"unknown partitioning {kind}")


def clustered_copy(df, path, columns, files=None, tie=None):
    """Copy sorted by the columns, so that row-group statistics skip most of it."""
    keys = list(columns) + ([tie] if tie else [])
    df.repartitionByRange(files or pieces(df), *keys).sortWithinPartitions(*keys).write.parquet(path)


def bucketed_pair(fact, dim, fact_key, dim_key, row_key, names, paths, buckets=None, salts=16):
    """Catalogue tables bucketed alike, to be joined on (key, salt) without an exchange.

    A key above 1/(4 * buckets) of the fact rows would fill a bucket.  At most
    4 * buckets such keys exist; their fact rows are spread over `salts` buckets
    by row key and their dimension rows repeated for each salt.  Rows are dealt
    out by bucket before the write, so a bucket is one file.
    """
    buckets = buckets or pieces(fact)
    counts = fact.groupBy(fact_key).agg(F.count(F.lit(1)).alias("n"))
    limit = counts.agg(F.sum("n") / F.lit(4.0 * buckets)).scalar()
    hot = F.broadcast(counts.where(F.col("n") > limit).select(F.col(fact_key).alias("hot_key")))
    is_hot = F.col("hot_key").isNotNull()
    salted = (fact.join(hot, F.col(fact_key) == F.col("hot_key"), "left")
              .withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64(row_key), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
              .drop("hot_key"))
    spread = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = (dim.join(hot, F.col(dim_key) == F.col("hot_key"), "left")
                .withColumn("salt", F.explode(spread)).drop("hot_key"))
    for df, key, name, path in ((salted, fact_key, names[0], paths[0]), (repeated, dim_key, names[1], paths[1])):
        df.repartition(buckets, key, "salt").write.bucketBy(buckets, key, "salt").sortBy(key, "salt").option("path", path).saveAsTable(name)


def drop_copy(spark, name):
    """Drop a clustered or bucketed copy; the base table is refused."""
    if name.upper() == "PRIMARY" or not name.startswith("tunewright_"):
        raise ValueError(f"{name} is not a copy made by this module")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def copy_name(purpose):
    return f"tunewright_{purpose}_{uuid.uuid4().hex[:12]}"


def column_profile(df, columns):
    """Rows, nulls, distinct values, minimum and maximum per column, exact.

    Values are reduced to one row per (column, value) before the shuffle and
    counted from there; the extremes are typed and need no shuffle of rows.
    """
    ends = df.agg(*[F.struct(F.min(c).cast("string").alias("lo"), F.max(c).cast("string").alias("hi")).alias(c)
                    for c in columns])
    ends = ends.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}.lo").alias("min_value"), F.col(f"{c}.hi").alias("max_value"))
        for c in columns])).alias("x")).select("x.*")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x")).select("x.*")
    per = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = per.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct_values"))
    # one row per profiled column on both sides
    return counts.join(F.broadcast(ends), "column_name")


def approximate_profile(df, columns):
    """One pass, constant memory: approximate distinct counts for very large tables."""
    wide = df.agg(F.count(F.lit(1)).alias("row_count"), *[
        F.struct((F.count(F.lit(1)) - F.count(c)).alias("nulls"), F.approx_count_distinct(c).alias("ndv")).alias(c)
        for c in columns])
    return wide.select("row_count", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}.nulls").alias("nulls"), F.col(f"{c}.ndv").alias("distinct_values"))
        for c in columns])).alias("x")).select("x.column_name", "row_count", "x.nulls", "x.distinct_values")


# ------------------------------------------------------------------ queries

def list_partitions(spark, sf_dir):
    path = shared_dir(spark, "list")
    partition_table(table(spark, sf_dir, "orders"), path, "o_orderstatus")
    return spark.read.parquet(path).where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def range_partitions(spark, sf_dir):
    path = shared_dir(spark, "range")
    partition_table(table(spark, sf_dir, "lineitem"), path, "l_shipdate", "RANGE", tie="l_orderkey")
    return (spark.read.parquet(path).where("l_shipdate >= timestamp_ntz'1998-01-01' AND l_shipdate < timestamp_ntz'1998-02-01'")
            .select("l_orderkey", "l_linenumber", "l_quantity"))


def hash_partitions(spark, sf_dir):
    path = shared_dir(spark, "hash")
    partition_table(table(spark, sf_dir, "orders"), path, "o_custkey", "HASH")
    return spark.read.parquet(path).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


def clustered(spark, sf_dir):
    path = shared_dir(spark, "clustered")
    clustered_copy(table(spark, sf_dir, "lineitem"), path, ["l_suppkey"], tie="l_orderkey")
    return spark.read.parquet(path).where("l_suppkey = 42").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


def bucketed_join(spark, sf_dir):
    """Join of two copies bucketed by the join key: no exchange on either side."""
    o, c = copy_name("orders"), copy_name("customer")
    bucketed_pair(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                  table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
                  "o_custkey", "c_custkey", "o_orderkey", (o, c),
                  (shared_dir(spark, "bucketed"), shared_dir(spark, "bucketed")))
    left, right = spark.table(o), spark.table(c).hint("merge")
    for name in (o, c):  # the plan holds what it needs; the files stay, the catalogue entry goes
        drop_copy(spark, name)
    return (left.join(right, (left.o_custkey == right.c_custkey) & (left.salt == right.salt))
            .select("o_orderkey", "c_name", "o_totalprice"))


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def statistics(spark, sf_dir):
    return column_profile(table(spark, sf_dir, "orders"), ORDER_COLUMNS)


def approximate_statistics(spark, sf_dir):
    """The approximate profile, whether its distinct counts are within a tenth of the exact ones, and which columns have so few values that a partition each would do."""
    orders, found = table(spark, sf_dir, "orders"), F.col("distinct_values")
    exact = column_profile(orders, ORDER_COLUMNS).select("column_name", F.col("distinct_values").alias("exact"))
    # one row per profiled column on both sides; a table without rows has no exact counts
    true = F.coalesce(F.col("exact"), F.lit(0))
    return approximate_profile(orders, ORDER_COLUMNS).join(F.broadcast(exact), "column_name", "left").select(
        "column_name", "row_count", "nulls", (F.abs(found - true) <= true * 0.1).alias("within_a_tenth"), (found <= 100).alias("few_values"))


def dropped_copy(spark, sf_dir):
    """A clustered copy made and dropped again: it has the rows of its base, which stays."""
    orders, name = table(spark, sf_dir, "orders"), copy_name("orders")
    path = shared_dir(spark, "dropped")
    clustered_copy(orders, path, ["o_custkey"], tie="o_orderkey")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    copied = spark.table(name).agg(F.count(F.lit(1)).alias("copy_rows"))
    copied = materialised(spark, copied, "copy-rows")
    drop_copy(spark, name)
    return copied.select("copy_rows", orders.agg(F.count(F.lit(1))).scalar().alias("base_rows"), F.lit(spark.catalog.tableExists(name)).alias("copy_exists"))


def denormalised(spark, sf_dir):
    """Orders with the market segment copied in."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    path = shared_dir(spark, "denormalised")
    o.join(c, o.o_custkey == c.c_custkey, "left").drop("c_custkey").write.parquet(path)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice", "c_mktsegment")


REWRITES = {
    "subqueries_to_join": (
        f"SELECT c_custkey, (SELECT count(*) FROM {{orders}} WHERE o_custkey = c_custkey) AS n, "
        f"coalesce((SELECT sum(CAST(o_totalprice AS {MONEY})) FROM {{orders}} WHERE o_custkey = c_custkey), 0) AS s FROM {{customer}}",
        f"SELECT c_custkey, coalesce(n, 0) AS n, coalesce(s, 0) AS s FROM {{customer}} LEFT JOIN (SELECT o_custkey, count(*) AS n, "
        f"sum(CAST(o_totalprice AS {MONEY})) AS s FROM {{orders}} GROUP BY o_custkey) o ON o_custkey = c_custkey"),
    "function_to_range": (
        "SELECT o_orderkey FROM {orders} WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3",
        "SELECT o_orderkey FROM {orders} WHERE o_orderdate >= timestamp_ntz'1997-03-01' AND o_orderdate < timestamp_ntz'1997-04-01'"),
    "comma_to_join": (
        "SELECT c_name, o_orderkey FROM {customer}, {orders} WHERE c_custkey = o_custkey AND o_totalprice > 300000",
        "SELECT c_name, o_orderkey FROM {customer} JOIN {orders} ON c_custkey = o_custkey WHERE o_totalprice > 300000"),
}


def plan_nodes(plan):
    """The operators of a plan that has run, stages and reused parts opened; a reused exchange is not entered twice."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return plan_nodes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return plan_nodes(plan.plan())
    if kind == "ReusedExchangeExec":
        return [(kind, plan)]
    children = plan.children()
    return [(kind, plan)] + [n for k in range(children.size()) for n in plan_nodes(children.apply(k))]


def plan_figures(df):
    """(result row, figures) of df after it has run: exchanges, joins, files and bytes opened, and rows that the scans returned."""
    row = df.collect()[0]  # of one row; the plan that runs is the frame's own
    nodes = plan_nodes(df._jdf.queryExecution().executedPlan())
    scans = [n for kind, n in nodes if kind == "FileSourceScanExec"]
    metric = lambda node, name: node.metrics().apply(name).value() if node.metrics().contains(name) else 0
    return row, {
        "exchanges": sum(kind in ("ShuffleExchangeExec", "BroadcastExchangeExec") for kind, _ in nodes),
        "joins": sum("Join" in kind for kind, _ in nodes),
        "files": sum(metric(n, "numFiles") for n in scans), "bytes": sum(metric(n, "filesSize") for n in scans),
        "rows_read": sum(metric(n, "numOutputRows") for n in scans)}


def forms(spark, sf_dir):
    """(rewrite, form, figures) of both forms of every rewrite; a form runs once, down to one row that checks its result."""
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer")}
    for name, pair in REWRITES.items():
        for form, text in zip(("slow", "fast"), pair):
            rows = spark.sql(text, **{k: v for k, v in t.items() if "{" + k + "}" in text})
            check = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("h"))
            yield name, form, *plan_figures(check)


def rewrite_effect(spark, sf_dir):
    """Slow form and rewrite of three statements: do they return the same rows, and how many rows and files does each read?"""
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer")}
    read = {}
    for name, form, _, figures in forms(spark, sf_dir):
        read[name, form] = figures
    rows = []
    for name, (slow, fast) in REWRITES.items():
        used = [{k: v for k, v in t.items() if "{" + k + "}" in q} for q in (slow, fast)]
        a, b = (materialised(spark, spark.sql(q, **u), "result") for q, u in zip((slow, fast), used))
        costs = [F.lit(read[name, form][what]).cast("bigint").alias(f"{what}_{form}") for form in ("slow", "fast") for what in ("rows_read", "files")]
        rows.append(result_diff(a, b).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("different_rows")).select("different_rows", F.lit(name).alias("rewrite"), *costs))
    return reduce(lambda x, y: x.unionByName(y), rows).withColumn("same_result", F.col("different_rows") == 0)


def rewrite_costs(spark, sf_dir):
    """Exchanges, joins, files, bytes and rows of both forms, as their plans ran."""
    rows = [(name, form, *(int(figures[k]) for k in ("exchanges", "joins", "files", "bytes", "rows_read"))) for name, form, _, figures in forms(spark, sf_dir)]
    return spark.createDataFrame(rows, "rewrite string, form string, exchanges long, joins long, files long, bytes long, rows_read long")


QUERIES = {
    "L1_list_partitions": list_partitions,
    "L1_range_partitions": range_partitions,
    "L1_hash_partitions": hash_partitions,
    "L2_clustered_copy": clustered,
    "L2_bucketed_join": bucketed_join,
    "L3_statistics": statistics,
    "L3_approximate_statistics": approximate_statistics,
    "L4_denormalised_column": denormalised,
    "L5_drop_copy": dropped_copy,
    "L6_rewrite_effect": rewrite_effect,
    "L6_rewrite_costs": rewrite_costs,
}
