"""Structured Streaming jobs: step scoring, curriculum and action counts.

Each job drains its input with an availableNow trigger and writes exactly once
into a fresh folder under the shared checkpoint folder.  Files of a stored table
arrive in any order, so a job never takes arrival for event order and never drops
a late row: what a late row changes is emitted again under a higher version, and
the newest version stands.  Results don't depend on where batches end.
"""

from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright import dims, kernels, views
from tunewright.operators import curriculum, ledger
from tunewright.session import shared_dir, table

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Soft limit of a micro-batch.
BYTES_PER_BATCH = 4 * 1024 ** 3


def _units(text):
    return int(Decimal(text) * kernels.SCALE)


def rules():
    """Reward constants as integers for the step kernel."""
    return {
        "step": {k: _units(v) for k, v in dims.STEP_REWARD.items()},
        "default": _units(dims.DEFAULT_STEP),
        "terminal": set(dims.TERMINAL_ACTIONS),
        "share": {k: int(Decimal(v) * 10) for k, v in dims.GRADE_SHARE.items()},
        "milestones": [(int(Decimal(s) * 100), _units(b)) for s, b in dims.MILESTONES],
        "target": dims.DEFAULT_TARGET * kernels.SCALE,
    }


def read_stream(spark, path, schema, **options):
    """File stream over a table folder or a single file: a glob accepts both, and this one matches no other name."""
    limits = options or {"maxBytesPerTrigger": BYTES_PER_BATCH}
    return spark.readStream.schema(schema).options(**limits).parquet(f"{path[:-1]}[{path[-1]}]")


def drain(frame, target, checkpoint, mode="append"):
    """Run a query over everything that is there and wait for its end."""
    query = (frame.writeStream.format("parquet").outputMode(mode).option("path", target)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def stateful(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


STEP_OUT = "episode_id bigint, event_id bigint, step_no bigint, reward double, total_reward double, done boolean, version bigint"


def newest(rows, key, version):
    """The rows of each key's highest version."""
    last = rows.groupBy(key).agg(F.max(version).alias("_last")).withColumnRenamed(key, "_key")
    return rows.join(last, (F.col(key) == F.col("_key")) & (F.col(version) == F.col("_last"))).drop("_key", "_last", version)


def score_stream(events):
    """Rewards per live step of a stream of events, again for each change of an episode's first steps."""
    steps = ledger.with_grade(events.selectExpr(*views.EPISODE_STEP))
    scaled = steps.select("episode_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "action_type",
                          (F.col("perf_score") * kernels.SCALE).cast("bigint").alias("perf"),
                          (F.col("grade") * kernels.SCALE).cast("bigint").alias("grade"))
    return scaled.groupBy("episode_id").transformWithStateInPandas(
        statefulProcessor=kernels.step_processor(rules(), dims.MAX_STEPS), outputStructType=STEP_OUT, outputMode="Append",
        timeMode="None")


def count_stream(events, late=None, width="1 hour"):
    """Actions per tumbling window.

    For live input `late` sets a watermark: state of older windows is dropped, and
    rows that come later than that with it.  A drain of a stored table has none.
    """
    timed = events.selectExpr(*views.EPISODE_STEP).withColumn("at", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("at", late) if late else timed
    return timed.groupBy(F.window("at", width), "action_type").agg(F.count(F.lit(1)).alias("n"))


def per_batch(events, checkpoint, keep, mode="append"):
    query = (events.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def scored_steps(spark, sf_dir, **options):
    stateful(spark)
    out, path = shared_dir(spark, "steps"), f"{sf_dir}/events.parquet"
    events = read_stream(spark, path, table(spark, sf_dir, "events").schema, **options)
    drain(score_stream(events), out, shared_dir(spark, "steps-state"))
    return newest(spark.read.schema(STEP_OUT).parquet(out), "episode_id", "version")


TIER_OUT = "learner_id bigint, event_id bigint, episode_no bigint, tier int, version bigint"
# A trigger's scores of one learner are held in one task: 24 bytes each.
SCORE_BYTES_PER_BATCH = 1024 ** 3


def tier_rules():
    """Window, and the sums of a full window from which a tier is gained and below which one is lost, in whole units."""
    return (dims.TIER_WINDOW, *(_units(mean) * dims.TIER_WINDOW for mean in (dims.ADVANCE_MEAN, dims.REGRESS_MEAN)))


def tier_stream(events):
    """Tier after each score, again for every score after a late one, whose episode number grows."""
    scores = events.selectExpr(*views.LEARNER_SCORE).select(
        curriculum.KEY, F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "event_id", (F.col("score") * kernels.SCALE).cast("bigint").alias("score"))
    return scores.groupBy(curriculum.KEY).transformWithStateInPandas(
        statefulProcessor=kernels.tier_processor(tier_rules()), outputStructType=TIER_OUT, outputMode="Append", timeMode="None")


def tiers(spark, sf_dir, **options):
    """Tier of every learner after each episode; of each place in a history the newest version stands."""
    stateful(spark)
    out, path = shared_dir(spark, "tiers"), f"{sf_dir}/events.parquet"
    events = read_stream(spark, path, table(spark, sf_dir, "events").schema, **(options or {"maxBytesPerTrigger": SCORE_BYTES_PER_BATCH}))
    drain(tier_stream(events), out, shared_dir(spark, "tiers-state"))
    last = F.max_by(F.struct("event_id", "tier"), "version").alias("last")
    return spark.read.schema(TIER_OUT).parquet(out).groupBy(curriculum.KEY, "episode_no").agg(last).select(
        curriculum.KEY, "last.event_id", "episode_no", "last.tier")


SESSION_OUT = "user_id bigint, kind string, lo bigint, hi bigint, n bigint, event_id bigint, version bigint"
GAP_MINUTES = 360
# Users share that many keys of state, so a trigger has no more calls of the processor than that.
USER_GROUPS = 4096


def session_stream(events, late, gap_minutes=GAP_MINUTES, groups=USER_GROUPS):
    """Runs of activity per user, closed when the watermark (`late` behind the newest event) has passed their gap, and late rows.

    The processor gets the time as a number: the engine follows the watermark and
    its timers, but drops no late row before the processor has seen it.
    """
    group = F.when(F.col("user_id").isNotNull(), F.pmod(F.xxhash64("user_id"), F.lit(groups)))
    timed = events.withWatermark("at", late).select(group.alias("users"), "user_id", "event_id", F.unix_micros("at").alias("us"))
    return timed.groupBy("users").transformWithStateInPandas(
        statefulProcessor=kernels.session_processor(gap_minutes * 60_000), outputStructType=SESSION_OUT, outputMode="Append", timeMode="EventTime")


def arrivals(spark, sf_dir, parts=4):
    """(events with the number of the delivery that brings them, their span in seconds): by time, but every tenth event one delivery late."""
    e = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    lo, hi = e.agg(F.min(F.unix_micros("at")), F.max(F.unix_micros("at"))).first()
    if lo is None:
        return e.withColumn("part", F.lit(0)), 0
    own = F.floor((F.unix_micros("at") - lo) * parts / (hi - lo + 1))
    return e.withColumn("part", (own + (F.col("event_id") % 10 == 0).cast("int")).cast("int")), (hi - lo) // 1_000_000


def delivered(spark, sf_dir, late_share, parts=4):
    """Output of the session job, run once after each delivery with what it has kept; `late_share` of the events' span is the watermark's delay."""
    stateful(spark)
    events, span = arrivals(spark, sf_dir, parts)
    inbox, out, state = (shared_dir(spark, f"sessions-{name}") for name in ("in", "out", "state"))
    events = events.select("user_id", "event_id", "at", "part")
    schema = events.drop("part").schema
    for part in range(parts + 1):
        events.where(F.col("part") == part).drop("part").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", BYTES_PER_BATCH).parquet(inbox)
        drain(session_stream(stream, f"{int(span * late_share)} seconds"), out, state)
    return spark.read.schema(SESSION_OUT).parquet(out)


def sessions(spark, sf_dir):
    """The runs of activity after the last delivery: closed ones, and those that are still open."""
    rows = delivered(spark, sf_dir, 0.5)
    runs = rows.where("kind = 'closed'").drop("version").unionByName(newest(rows.where("kind = 'open'"), "user_id", "version").where("n > 0"))
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("lo")).cast("bigint")
    return runs.select("user_id", number.alias("session"), F.col("n").alias("n_events"), (F.col("hi") - F.col("lo")).alias("length_us"))


def late_rows(spark, sf_dir):
    """Events that came after the watermark had passed them, and so count in no run."""
    return delivered(spark, sf_dir, 0.05).where("kind = 'late'").select("user_id", "event_id")


def action_counts(spark, sf_dir, **options):
    """Window counts in update mode; the newest count of a window stands."""
    stateful(spark)
    out, path = shared_dir(spark, "counts"), f"{sf_dir}/events.parquet"
    events = read_stream(spark, path, table(spark, sf_dir, "events").schema, **options)

    def keep(batch, number):
        batch.select(F.unix_seconds("window.start").alias("window_start"), "action_type", "n").write.mode("overwrite").parquet(f"{out}/batch={number}")

    per_batch(count_stream(events), shared_dir(spark, "counts-state"), keep, "update")
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    return rows.groupBy("window_start", "action_type").agg(F.max_by("n", "batch").alias("n"))


QUERIES = {
    "C6_streaming_steps": scored_steps,
    "C7_streaming_tiers": tiers,
    "C8_streaming_action_counts": action_counts,
    "C8_streaming_sessions": sessions,
    "C8_streaming_late_rows": late_rows,
}
