"""Column statistics as sketches per file, that later files are merged into, and their use by the optimiser.

One row per (file, column): rows, nulls, smallest and largest value, a HyperLogLog
sketch of the distinct values and a KLL sketch of the order.  A refresh sketches only
files that the stored table does not know; the profile of a table is the merge of the
rows of its files, so no file is read twice and nothing but sketches is shuffled.
"""

from functools import reduce

from pyspark.sql import functions as F

from tunewright.operators.layout import copy_name, drop_copy
from tunewright.session import materialised, shared_dir, table

HLL_BITS = 14
QUANTILES = (0.25, 0.5, 0.75)
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _sketches(rows, columns):
    """(file, column_name, rows, nulls, lo, hi, distinct, ordered) of rows that carry their file's name."""
    kinds = dict(rows.dtypes)
    def one(c):
        number = F.col(c).cast("double") if kinds[c] in NUMBERS else F.lit(None).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"),
            F.min(c).cast("string").alias("lo"), F.max(c).cast("string").alias("hi"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(HLL_BITS)).alias("distinct"),
            F.kll_sketch_agg_double(number).alias("ordered"), F.lit(kinds[c]).alias("kind"))
    # one shuffle of one row a file and task
    return rows.groupBy("file").agg(*[one(c).alias(c) for c in columns]).select("file", F.inline(F.array(*[F.col(c) for c in columns])))


def refreshed(spark, path, columns, stored=None):
    """The stored statistics of a table folder with those of files that came since; `stored` is a folder or None at first."""
    rows = spark.read.parquet(path).select(F.input_file_name().alias("file"), *columns)
    if stored is None:
        return _sketches(rows, columns)
    known = spark.read.parquet(stored)
    # names of files: one row each
    fresh = sorted(set(spark.read.parquet(path).inputFiles()) - {r["file"] for r in known.select("file").distinct().collect()})
    if not fresh:
        return known
    return known.unionByName(_sketches(spark.read.parquet(*fresh).select(F.input_file_name().alias("file"), *columns), columns))


def merged(statistics):
    """(column_name, files, row_count, nulls, lo, hi, distinct_values, quantiles) from sketches alone; the extremes by the column's own type."""
    number = F.col("kind").isin(*NUMBERS)
    ends = lambda pick, c: F.coalesce(pick(F.when(number, F.struct(F.col(c).cast("double"), F.col(c))))[c], pick(F.when(~number, F.col(c))))
    per = statistics.groupBy("column_name", "kind").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("row_count"), F.sum("nulls").alias("nulls"), ends(F.min, "lo").alias("lo"), ends(F.max, "hi").alias("hi"),
        F.hll_union_agg("distinct").alias("d"), F.kll_merge_agg_double("ordered").alias("q"))
    ranks = F.array(*[F.lit(q) for q in QUANTILES])
    return per.select("column_name", "files", "row_count", "nulls", "lo", "hi", F.hll_sketch_estimate("d").alias("distinct_values"),
                      F.when(F.col("kind").isin(*NUMBERS), F.kll_sketch_get_quantile_double("q", ranks)).alias("quantiles"))


# ------------------------------------------------------------------ queries

COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def kept_up(spark, sf_dir, deliveries=3):
    """Statistics of orders that come in deliveries, refreshed after each."""
    orders, path, stored = table(spark, sf_dir, "orders"), shared_dir(spark, "deliveries"), None
    for k in range(deliveries):
        orders.where(F.col("o_orderkey") % deliveries == k).write.mode("append").parquet(path)
        now = shared_dir(spark, "sketches")
        refreshed(spark, path, COLUMNS, stored).write.parquet(now)
        stored = now
    return merged(spark.read.parquet(stored))


def refreshed_profile(spark, sf_dir):
    """Rows, nulls and extremes of orders, merged from the statistics of the files of three deliveries."""
    return kept_up(spark, sf_dir).select("column_name", "row_count", "nulls", F.col("lo").alias("min_value"), F.col("hi").alias("max_value"))


def estimates(spark, sf_dir):
    """Distinct values and quartiles of orders, estimated from merged sketches."""
    return kept_up(spark, sf_dir).select("column_name", "distinct_values", "quantiles")


def analysed_join(spark, sf_dir, note=None):
    """Orders of one priority and status per customer segment, joined in the order that analysed tables suggest.

    The tables are copies in the catalogue; ANALYZE TABLE gives the optimiser rows,
    distinct values and ranges, from which it estimates what the filters leave.
    """
    names = {n: copy_name(n) for n in ("orders", "customer", "nation")}
    for n, name in names.items():
        table(spark, sf_dir, n).write.option("path", shared_dir(spark, "analysed")).saveAsTable(name)
    text = """SELECT n_name, c_mktsegment, count(*) AS n FROM {o} JOIN {c} ON o_custkey = c_custkey JOIN {n} ON c_nationkey = n_nationkey
              WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND n_regionkey = 1 GROUP BY n_name, c_mktsegment""".format(**{k[0]: v for k, v in names.items()})
    keys = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled", "spark.sql.statistics.histogram.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "true")
        plain = spark.sql(text)
        if note is not None:
            note["before"] = plain._jdf.queryExecution().optimizedPlan().toString()
        for name in names.values():
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
        costed = spark.sql(text)
        if note is not None:
            note["after"] = costed._jdf.queryExecution().optimizedPlan().toString()
        return materialised(spark, costed, "analysed-join")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for name in names.values():
            drop_copy(spark, name)


QUERIES = {"L3_refreshed_profile": refreshed_profile, "L3_sketch_estimates": estimates, "L3_cost_based_join": analysed_join}
