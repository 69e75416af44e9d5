"""Ordered computations per key that stay balanced when one key is huge.

A window over (key) puts all rows of the key into one task.  Here the few keys
above a row limit are cut into time segments; the window then runs per
(key, segment) and what crosses a segment border travels as a small summary.

The keys above max(min_rows, 1/100000 of all rows) number fewer than 100000 by
construction, so their list (a few MB at most) may be broadcast at any scale.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright.session import materialised

MIN_ROWS = 1_000_000
SHARE = 1e-5
# Segments are cut by time; more of them than needed absorb bursts.
SPREAD = 8


def micros(ts):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def hot_keys(df, key, ts, min_rows=None):
    """Keys with too many rows for one task: key, first instant, segment width."""
    min_rows = MIN_ROWS if min_rows is None else min_rows
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(micros(ts)).alias("lo"),
                                 F.max(micros(ts)).alias("hi"))
    limit = F.greatest(F.lit(float(min_rows)), counts.agg(F.sum("n") * F.lit(SHARE)).scalar())
    pieces = F.ceil(F.col("n") / F.lit(min_rows)) * SPREAD
    return counts.where(F.col("n") > limit).select(
        F.col(key).cast("bigint").alias("hot_key"), "lo",
        F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / pieces)).cast("bigint").alias("width"))


def hot_list(df, key, ts, min_rows=None):
    """The hot keys as a local frame, or None when there are none.

    The list is bounded (see above), so it may visit the driver; knowing that it
    is empty saves ordinary data every step of the segmented path.
    """
    found = hot_keys(df, key, ts, min_rows).collect()
    return df.sparkSession.createDataFrame(found, "hot_key bigint, lo bigint, width bigint") if found else None


def with_segment(df, key, ts, hot):
    """Add seg (0 for ordinary keys) and is_hot."""
    seg = F.floor((micros(ts) - F.col("lo")) / F.col("width"))
    return (df.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
            .withColumn("seg", F.coalesce(seg, F.lit(0)).cast("bigint"))
            .withColumn("is_hot", F.col("hot_key").isNotNull())
            .drop("hot_key", "lo", "width"))


def with_halo(rows, key, order, size):
    """Copy the last `size` rows before each segment into it, flagged halo.

    `size` earlier segments always hold `size` rows, because no segment is empty.
    """
    own = Window.partitionBy(key, "seg").orderBy(*[F.desc(c) for c in order])
    payload = [c for c in rows.columns if c not in (key, "seg", "is_hot")]
    item = F.struct(*order, *[c for c in payload if c not in order])
    tails = (rows.where("is_hot").withColumn("r", F.row_number().over(own)).where(F.col("r") <= size)
             .groupBy(key, "seg").agg(F.array_sort(F.collect_list(item)).alias("tail")))
    earlier = Window.partitionBy(key).orderBy("seg").rowsBetween(-size, -1)
    halo = (tails.withColumn("before", F.array_sort(F.flatten(F.collect_list("tail").over(earlier))))
            .where(F.size("before") > 0)
            .select(key, "seg", F.inline(F.slice("before", -F.least(F.size("before"), F.lit(size)),
                                                 F.least(F.size("before"), F.lit(size)))))
            .withColumn("is_hot", F.lit(True)).withColumn("halo", F.lit(True)))
    return rows.withColumn("halo", F.lit(False)).unionByName(halo)


def running(df, key, order, values, min_rows=None):
    """df with running aggregates of each key's rows in the order (time first): name -> ("sum" or "max", column).

    A key with too many rows for one task is cut into time segments; what the
    earlier segments add up to is joined to a segment's own running values.
    """
    hot = hot_list(df, key, order[0], min_rows)
    add = {"sum": F.sum, "max": F.max}
    rows = df if hot is None else with_segment(df, key, order[0], hot)
    keys = [key] if hot is None else [key, "seg"]
    rows = rows.select("*", *[c.alias(f"_{name}") for name, (_, c) in values.items()])
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[add[kind](f"_{name}").over(w).alias(name) for name, (kind, _) in values.items()])
    if hot is None:
        return rows.select(*df.columns, *values)
    parts = rows.where("is_hot").groupBy(key, "seg").agg(*[add[kind](f"_{name}").alias(f"_{name}") for name, (kind, _) in values.items()])
    earlier = Window.partitionBy(key).orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col(key).alias("_key"), F.col("seg").alias("_seg"),
                         *[add[kind](f"_{name}").over(earlier).alias(f"_before_{name}") for name, (kind, _) in values.items()])
    both = rows.join(parts, (F.col(key) == F.col("_key")) & (F.col("seg") == F.col("_seg")), "left")
    carried = {name: F.coalesce(F.col(name) + F.col(f"_before_{name}"), F.col(name)) if kind == "sum"
               else F.greatest(F.col(name), F.col(f"_before_{name}")) for name, (kind, _) in values.items()}
    return both.select(*df.columns, *[c.alias(name) for name, c in carried.items()])


def numbered(spark, df, key, order, name="rank"):
    """df with each row's place from 0 in its key by the order; ties are broken as the rows come.

    One global sort numbers the rows of every task through; how many rows of a key the
    earlier tasks hold is a table of one row per key and task.  No window spans a key.
    """
    rows = materialised(spark, df.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    rows = materialised(spark, rows.orderBy(key, *order, "_id").drop("_id").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    counts = rows.groupBy(key, F.shiftright("_at", 33).alias("_task")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(key).alias("_key"), F.col("_task").alias("_of"), "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    both = rows.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.shiftright("_at", 33) == F.col("_of")))
    return both.select(*df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(name))
