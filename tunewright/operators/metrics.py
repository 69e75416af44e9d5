"""Evaluation metrics: policy comparison and metric series."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright.functions.text import amount4, dbl, round4
from tunewright.session import table

MONEY = "decimal(18,2)"


def _mean(value, cond=None):
    v = F.col(value).cast(MONEY)
    if cond is None:
        return F.sum(v).cast("double") / F.count(value)
    return F.sum(F.when(cond, v)).cast("double") / F.sum(F.when(cond, 1))


def policies(spark, sf_dir):
    """Per scenario (nation): gain of two policies (market segments) over the common level."""
    c = table(spark, sf_dir, "customer")
    per = c.groupBy(F.col("c_nationkey").alias("scenario_no")).agg(
        _mean("c_acctbal").alias("base"),
        _mean("c_acctbal", F.col("c_mktsegment") == "BUILDING").alias("a"),
        _mean("c_acctbal", F.col("c_mktsegment") == "MACHINERY").alias("b"))

    def gain(x):
        return F.round(F.greatest(F.lit(0.0), F.coalesce(F.col(x), F.col("base")) - F.col("base")).cast("decimal(18,10)"), 4)
    return per.select("scenario_no", gain("a").alias("random"), gain("b").alias("strategic"))


def comparison(spark, sf_dir):
    p = policies(spark, sf_dir)
    return p.select("scenario_no", dbl(F.col("random"), "random"), dbl(F.col("strategic"), "strategic"),
                    (F.col("strategic") > F.col("random")).alias("wins"))


def averages(spark, sf_dir):
    """Mean gains and the relative gain; 'inf' when the first policy gains nothing."""
    a = policies(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.sum("random").cast("double").alias("r"),
                                    F.sum("strategic").cast("double").alias("s"))
    r, s = F.col("r") / F.col("n"), F.col("s") / F.col("n")
    gain = (s - r) / F.greatest(r, F.lit(0.001)) * 100
    return a.select(dbl(round4(r), "avg_r"), dbl(round4(s), "avg_s"),
                    F.when(r < 0.01, "inf").otherwise(F.format_string("%.2f", round4(gain).cast("double"))).alias("relative_gain"))


def cumulative(spark, sf_dir):
    """Running mean in scenario order; one row per scenario and policy."""
    long = policies(spark, sf_dir).select("scenario_no", F.expr("stack(2, 'random', random, 'strategic', strategic) AS (policy, gain)"))
    w = Window.partitionBy("policy").orderBy("scenario_no").rowsBetween(Window.unboundedPreceding, 0)
    return long.select("policy", "scenario_no",
                       dbl(round4(F.sum("gain").over(w).cast("double") / F.count("gain").over(w)), "running_mean"))


def extremes(spark, sf_dir):
    p = policies(spark, sf_dir)
    key = F.struct(F.col("strategic"), -F.col("scenario_no"))
    low = F.struct(F.col("strategic"), F.col("scenario_no"))
    return p.agg(F.max_by("scenario_no", key).alias("best_scenario"), F.max("strategic").cast("double").alias("best_gain"),
                 F.min_by("scenario_no", low).alias("worst_scenario"), F.min("strategic").cast("double").alias("worst_gain"))


def outliers(spark, sf_dir, sigmas=1.5):
    """Customers whose order count is far from the mean (population deviation)."""
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    mean, dev = per.agg(F.avg("n")).scalar(), per.agg(F.stddev_pop("n")).scalar()
    return per.where(F.abs(F.col("n") - mean) > F.lit(sigmas) * dev)


def daily(spark, sf_dir):
    """Daily mean per event type: the metric series (calendar-many rows)."""
    e = table(spark, sf_dir, "events")
    per = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum(F.col("value").cast(MONEY)).alias("s"), F.count(F.lit(1)).alias("n"))
    return per.select("event_type", "day", F.round((F.col("s").cast("double") / F.col("n")).cast("decimal(18,10)"), 6).alias("v"))


def moving_average(spark, sf_dir, size=10):
    """Mean of the last `size` points, from the first full window on."""
    w = Window.partitionBy("event_type").orderBy("day")
    frame = w.rowsBetween(1 - size, 0)
    rows = daily(spark, sf_dir).select("event_type", "day", F.row_number().over(w).alias("step"), F.sum("v").over(frame).alias("s"))
    return rows.where(F.col("step") >= size).select(
        "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), dbl(round4(F.col("s").cast("double") / float(size)), "mean"))


def change(spark, sf_dir):
    """Percent change from the first to the last point of each series."""
    ends = daily(spark, sf_dir).groupBy("event_type").agg(
        F.min_by("v", "day").cast("double").alias("a"), F.max_by("v", "day").cast("double").alias("b"))
    pct = (F.col("b") - F.col("a")) / F.greatest(F.abs("a"), F.lit(1e-9)) * 100
    return ends.select("event_type", F.col("a").alias("first_value"), F.col("b").alias("last_value"), dbl(amount4(pct), "change_pct"))


QUERIES = {
    "M1_policy_comparison": comparison,
    "M2_relative_gain": averages,
    "M3_cumulative_mean": cumulative,
    "M4_outliers": outliers,
    "M5_moving_average": moving_average,
    "M6_first_last_change": change,
    "M9_best_worst": extremes,
}
