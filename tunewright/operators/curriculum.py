"""Curriculum: rolling mean of a learner's scores drives a saturating tier walk."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright import dims, kernels, views
from tunewright.operators import scan
from tunewright.session import materialised, table

KEY, ORDER = "learner_id", ("ts", "event_id")


def scores_of(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*views.LEARNER_SCORE)


def rolling(scores, hot=None):
    """Mean of the last five scores per row (NULL before the fifth) and the tier shift it asks for.

    hot lists the learners to cut into segments (see scan.hot_list).
    """
    if hot is None:
        rows = scores.select("*", F.lit(0).cast("bigint").alias("seg"), F.lit(False).alias("is_hot"), F.lit(False).alias("halo"))
    else:
        rows = scan.with_halo(scan.with_segment(scores, KEY, "ts", hot), KEY, ORDER, dims.TIER_WINDOW - 1)
    w = Window.partitionBy(KEY, "seg").orderBy(*ORDER)
    last = w.rowsBetween(1 - dims.TIER_WINDOW, 0)
    full = F.col("seen") == dims.TIER_WINDOW
    mean_at_least = F.lit(dims.ADVANCE_MEAN).cast("decimal(4,2)") * dims.TIER_WINDOW
    mean_below = F.lit(dims.REGRESS_MEAN).cast("decimal(4,2)") * dims.TIER_WINDOW
    rows = rows.select("*", F.sum("score").over(last).alias("sum5"), F.count("score").over(last).alias("seen"),
                       F.sum(F.when(F.col("halo"), 0).otherwise(1)).over(
                           w.rowsBetween(Window.unboundedPreceding, 0)).alias("nth"))
    return rows.where(~F.col("halo")).select(
        KEY, "seg", "is_hot", *ORDER, "score", "nth",
        F.when(full, F.col("sum5").cast("double") / float(dims.TIER_WINDOW)).alias("mean5"),
        F.when(full & (F.col("sum5") >= mean_at_least), 1)
        .when(full & (F.col("sum5") < mean_below), -1).otherwise(0).alias("shift"))


def segment_starts(rows):
    """Start tier and rows before each segment of the huge learners.

    A segment acts on the tiers as one map x -> min(high, max(low, x + add));
    composing the maps of the earlier segments gives its start.
    """
    effects = (rows.where("is_hot").select(KEY, "seg", *ORDER, "shift").sortWithinPartitions(KEY, "seg", *ORDER)
               .mapInPandas(kernels.segment_effect,
                            "learner_id bigint, seg bigint, n bigint, add bigint, low bigint, high bigint"))
    return (effects.repartition(KEY).sortWithinPartitions(KEY, "seg")
            .mapInPandas(kernels.segment_starts,
                         "learner_id bigint, seg bigint, start_tier int, rows_before bigint"))


def walk(scores, min_rows=None):
    """Tier before and after every episode of every learner, plus the episode number.

    Ordinary learners are one segment and start at tier 0: one exchange, one
    sort.  The window of `rolling` has already clustered and ordered the rows as
    the kernel needs them.
    """
    hot = scan.hot_list(scores, KEY, "ts", min_rows)
    rows = rolling(scores, hot)
    start, before = F.lit(0), F.lit(0)
    if hot is not None:
        rows = rows.join(segment_starts(rows), [KEY, "seg"], "left")
        start, before = F.coalesce("start_tier", F.lit(0)), F.coalesce("rows_before", F.lit(0))
        # the window pins clustering by segment for the kernel, whatever join was chosen
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(KEY, "seg").orderBy(*ORDER)))
    rows = rows.select(KEY, "seg", *ORDER, "score", "mean5", "shift", start.cast("int").alias("start_tier"),
                       (before + F.col("nth")).cast("bigint").alias("episode_no"))
    return (rows.sortWithinPartitions(KEY, "seg", *ORDER)
            .mapInPandas(kernels.tier_walk,
                         "learner_id bigint, seg bigint, ts timestamp_ntz, event_id bigint, score decimal(6,4), mean5 double, "
                         "shift int, start_tier int, episode_no bigint, tier_before int, tier int")
            .select(KEY, "event_id", "episode_no", "score", "mean5", "tier_before", "tier"))


def tier_name(c):
    return F.element_at(F.array(*[F.lit(t) for t in dims.TIERS]), c + 1)


def rolling_mean(spark, sf_dir):
    scores = scores_of(spark, sf_dir)
    return rolling(scores, scan.hot_list(scores, KEY, "ts")).select(KEY, "event_id", "mean5")


def tier_after_episode(spark, sf_dir):
    return walk(scores_of(spark, sf_dir)).select(KEY, "event_id", "episode_no", "tier")


def changes(walked):
    return walked.where("tier <> tier_before").select(
        KEY, "episode_no", F.when(F.col("tier") > F.col("tier_before"), "advance").otherwise("regress").alias("direction"),
        tier_name(F.col("tier")).alias("new_tier"), "mean5")


def history(spark, sf_dir):
    return changes(walk(scores_of(spark, sf_dir)))


def learner_stats(spark, sf_dir):
    """Mean of the last 5 and last 20 scores, tier, episodes and the last five tier changes.

    The walk feeds two reductions, so it is written once and read twice.
    """
    walked = materialised(spark, walk(scores_of(spark, sf_dir)), "walk")
    recent = Window.partitionBy(KEY).orderBy(F.desc("episode_no"))
    changed = Window.partitionBy(KEY, "moved").orderBy(F.desc("episode_no"))
    rows = walked.select(KEY, "episode_no", "score", "tier", (F.col("tier") != F.col("tier_before")).alias("moved"))
    last = rows.withColumn("r", F.row_number().over(recent)).where("r <= 20")
    score = F.col("score")
    stats = last.groupBy(KEY).agg(
        F.max("episode_no").alias("episodes_run"),
        F.round((F.sum(F.when(F.col("r") <= 5, score)) / F.sum(F.when(F.col("r") <= 5, 1))).cast("decimal(18,10)"), 3)
        .cast("double").alias("recent_avg"),
        F.round((F.sum(score) / F.count(score)).cast("decimal(18,10)"), 3).cast("double").alias("all_time_avg"),
        tier_name(F.max_by("tier", "episode_no")).alias("current_tier"))
    moves = (rows.where("moved").withColumn("r", F.row_number().over(changed)).where("r <= 5").groupBy(KEY)
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("episode_no", "tier"))),
                                           lambda x: F.concat_ws(":", x["episode_no"], tier_name(x["tier"]))), ",")
                  .alias("tier_history")))
    return stats.join(moves, KEY, "left").withColumn("tier_history", F.coalesce("tier_history", F.lit("")))


def next_difficulty(spark, sf_dir):
    """Tier for the next episode; the generator knows nothing above hard."""
    last = walk(scores_of(spark, sf_dir)).groupBy(KEY).agg(F.max_by("tier", "episode_no").alias("t"))
    return last.select(KEY, tier_name(F.least(F.col("t"), F.lit(2))).alias("difficulty"))


def idle_sessions(spark, sf_dir, gap_minutes=360):
    """Runs of activity per user that end after an idle gap.

    Two events in the same gap-wide slot are always in the same run, so rows are
    first reduced to one per (user, slot); the window then sees calendar-many rows.
    """
    gap = gap_minutes * 60 * 1_000_000
    slots = (table(spark, sf_dir, "events").select("user_id", scan.micros("ts").alias("us"))
             .groupBy("user_id", F.floor(F.col("us") / gap).alias("slot"))
             .agg(F.min("us").alias("lo"), F.max("us").alias("hi"), F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("user_id").orderBy("slot")
    fresh = F.coalesce(F.col("lo") - F.lag("hi").over(w) >= gap, F.lit(True))
    runs = (slots.withColumn("fresh", fresh)
            .withColumn("session", F.sum(F.col("fresh").cast("bigint")).over(w)))
    return runs.groupBy("user_id", "session").agg(
        F.sum("n").alias("n_events"), (F.max("hi") - F.min("lo")).alias("length_us"))


QUERIES = {
    "C1_rolling_mean": rolling_mean,
    "C2_tier_walk": tier_after_episode,
    "C3_tier_changes": history,
    "C4_learner_stats": learner_stats,
    "C5_next_difficulty": next_difficulty,
    "C8_idle_sessions": idle_sessions,
}
