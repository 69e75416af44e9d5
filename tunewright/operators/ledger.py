"""Reward ledger: every step of every episode scored in one pass.

An episode ends after MAX_STEPS actions, so only the first MAX_STEPS rows of an
episode are ever ranked past the map side: row_number() <= 50 becomes a
WindowGroupLimit before the exchange, and one episode that holds a third of the
log still ships at most 50 rows per input partition.  All windows share one
partitioning and one ordering: one exchange and one sort for the whole ledger.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright import dims, views
from tunewright.functions import credit
from tunewright.functions.text import clamp, dbl, round4
from tunewright.operators import scan
from tunewright.session import table

DEC = "decimal(18,4)"


def _dec(text):
    return F.lit(text).cast(DEC)


def in_episode():
    return Window.partitionBy("episode_id").orderBy("ts", "event_id")


def episode_log(steps):
    """Number the steps of an episode and keep those inside the budget."""
    return (steps.withColumn("rn", F.row_number().over(in_episode()))
            .where(F.col("rn") <= dims.MAX_STEPS)
            .withColumn("step_no", F.col("rn").cast("bigint")).drop("rn"))


def with_grade(steps):
    """Grade of the answer that a graded action carries (others: NULL).

    The answer of a step is derived from its event; the case belongs to the user.
    Steps without an answer have no task and skip the text work.
    """
    graded = F.col("action_type").isin(*dims.GRADE_SHARE)
    made = [x for x in views.CASE_SUBMISSION if x not in ("event_id", "user_id", "ts")]
    answer = (steps.withColumn("user_id", F.col("episode_id")).selectExpr(*steps.columns, *made)
              .withColumn("task_id", F.when(graded, F.col("task_id"))))
    facts = credit.case_facts(dims.case_table(steps.sparkSession))
    scored = credit.with_case_grade(answer, facts)
    return scored.select(*steps.columns, F.when(graded, F.col("grade")).cast(DEC).alias("grade"))


def ledger(steps, target=dims.DEFAULT_TARGET, graded=True):
    """All reward parts per step.

    steps: episode_id, event_id, ts, action_type, perf_score (decimal).
    """
    w = in_episode()
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    act, perf, base, step = F.col("action_type"), F.col("perf_score"), F.col("baseline"), F.col("step_no")

    log = episode_log(steps)
    log = with_grade(log) if graded else log.withColumn("grade", F.lit(None).cast(DEC))
    log = log.select(
        "*",
        F.first("perf_score").over(so_far).alias("baseline"),
        F.lag("perf_score").over(w).alias("prev_perf"),
        F.lag("action_type").over(w).alias("prev_action"))

    rewards = F.create_map(*[x for k, v in dims.STEP_REWARD.items() for x in (F.lit(k), _dec(v))])
    gap = F.greatest(F.lit(1), F.lit(100) - base)
    delta = F.coalesce(perf - F.col("prev_perf"), F.lit(0)).cast(DEC)
    usable = (base > 0) & (perf > 0)
    log = log.select(
        "*",
        F.coalesce(F.try_element_at(rewards, act), _dec(dims.DEFAULT_STEP)).alias("step_reward"),
        delta.alias("delta"),
        # share of the gap closed, kept undivided so that it stays exact
        F.when(usable, perf - base).alias("gained"), gap.alias("gap"),
        act.isin(*dims.TERMINAL_ACTIONS).alias("is_terminal"),
        F.when(~act.eqNullSafe(F.col("prev_action")), step).alias("run_start"))

    log = log.select(
        "*",
        F.max("gained").over(before).alias("gained_before"),
        (step - F.max("run_start").over(so_far) + 1).alias("run_pos"),
        F.sum((act == "request_hint").cast("bigint")).over(so_far).alias("hints_used"),
        F.max("perf_score").over(so_far).alias("best_perf"))

    def crossed(share):
        need = F.lit(share).cast("decimal(4,2)") * F.col("gap")
        first = F.col("gained_before").isNull() | (F.col("gained_before") < need)
        return F.coalesce((F.col("gained") >= need) & first, F.lit(False))

    bonus = reduce(lambda a, b: a + b,
                   [F.when(crossed(s), _dec(v)).otherwise(_dec("0")) for s, v in dims.MILESTONES])
    hit = F.array_join(F.filter(F.array(*[
        F.when(crossed(s), F.lit(s)) for s, _ in dims.MILESTONES]), lambda x: x.isNotNull()), ",")
    bounded = F.greatest(_dec("-0.40"), F.least(_dec("0.40"), F.round(delta * F.lit("0.004").cast("decimal(4,3)"), 4)))
    saved = (F.lit(dims.MAX_STEPS) - step).cast("decimal(10,0)")
    efficient = F.when(step <= 35, (saved * F.lit("0.002").cast("decimal(4,3)")).cast(DEC)).otherwise(_dec("0"))
    report = act == "submit_report"
    closed = F.col("gained").cast("double") / F.col("gap").cast("double")
    spare = F.lit(1.0) - step.cast("double") / F.lit(float(dims.MAX_STEPS))
    terminal = (F.when(report & usable, clamp(round4(closed * 0.60 + spare * 0.20 + F.lit(0.10))))
                .when(report, _dec("0.10")).otherwise(_dec("0")))
    share = F.create_map(*[x for k, v in dims.GRADE_SHARE.items()
                           for x in (F.lit(k), F.lit(v).cast("decimal(3,1)"))])
    part = F.when(F.col("grade").isNotNull(),
                  F.round(F.col("grade") * F.try_element_at(share, act), 4).cast(DEC)).otherwise(_dec("0"))
    paid_off = (report & usable) | (F.col("is_terminal") & ~report & (F.coalesce(F.col("grade"), _dec("0")) >= _dec("0.5")))

    log = log.select(
        "*",
        F.when(delta != 0, bounded).otherwise(_dec("0")).cast(DEC).alias("delta_reward"),
        bonus.alias("milestone_bonus"), hit.alias("milestones"),
        F.when(F.col("run_pos") >= 2, F.lit("-0.08").cast("decimal(4,2)")
               * F.least(F.col("run_pos") - 1, F.lit(3)).cast("decimal(2,0)"))
        .otherwise(_dec("0")).cast(DEC).alias("loop_penalty"),
        F.when(act == "request_hint", _dec("-0.10")).otherwise(_dec("0")).alias("hint_penalty"),
        F.when(delta < -1, _dec("-0.05")).otherwise(_dec("0")).alias("backtrack_penalty"),
        F.when((step >= dims.MAX_STEPS - 2) & ~F.col("is_terminal"), _dec("-0.15"))
        .otherwise(_dec("0")).alias("budget_penalty"),
        F.when(paid_off, efficient).otherwise(_dec("0")).alias("efficiency_bonus"),
        terminal.cast(DEC).alias("terminal_score"),
        part.alias("grader_part"),
        (F.col("is_terminal") | (step >= dims.MAX_STEPS) | (F.coalesce(F.col("grade"), _dec("0")) >= 1)
         | (perf >= target)).alias("done"))

    log = log.withColumn("reward", clamp(reduce(lambda a, b: a + b, [F.col(p) for p in PARTS])))
    return log.select(
        "*",
        F.coalesce(F.max("done").over(before), F.lit(False)).alias("finished_before"),
        F.sum("reward").over(so_far).cast(DEC).alias("total_reward"))


PARTS = ("step_reward", "delta_reward", "milestone_bonus", "terminal_score", "grader_part",
         "efficiency_bonus", "loop_penalty", "hint_penalty", "backtrack_penalty", "budget_penalty")


def live(steps, **options):
    """Ledger without the rows that follow the end of the episode."""
    return ledger(steps, **options).where(~F.col("finished_before"))


def summary(steps, **options):
    """One row per episode."""
    order = F.struct("ts", "event_id")
    span = (F.unix_micros(F.max(F.col("ts").cast("timestamp")))
            - F.unix_micros(F.min(F.col("ts").cast("timestamp"))))
    out = live(steps, **options).groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("total_steps"),
        F.sum("reward").cast(DEC).alias("total"),
        F.max("hints_used").alias("hints_used"),
        F.round(span.cast("decimal(20,0)") / 1000000, 2).alias("duration"),
        F.max_by("perf_score", order).alias("final_score"),
        F.max("baseline").alias("base"),
        F.max("best_perf").alias("best"),
        F.array_join(F.array_sort(F.filter(F.collect_list("milestones"), lambda m: m != "")), ",").alias("milestones"),
        F.max("done").alias("done"))
    return out.select(
        "episode_id", "total_steps", dbl(F.col("total"), "total_reward"), "hints_used",
        dbl(F.col("duration"), "duration_sec"), dbl(F.col("final_score"), "final_score"),
        dbl(F.col("base"), "baseline_score"),
        dbl(F.round(F.col("final_score") - F.col("base"), 2), "improvement"),
        dbl(F.col("best"), "best_score"), "milestones", "done")


def steps_of(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*views.EPISODE_STEP)


AMOUNTS = set(PARTS) | {"perf_score", "baseline", "delta", "grade", "reward", "total_reward", "best_perf"}


def _ledger_query(*columns):
    """Columns of the live steps: an episode pays nothing for actions after its end, so those have no reward parts."""
    def run(spark, sf_dir):
        rows = live(steps_of(spark, sf_dir))
        return rows.select("episode_id", "event_id", "step_no",
                           *[dbl(F.col(c), c) if c in AMOUNTS else F.col(c) for c in columns])
    return run


def external_reward(spark, sf_dir):
    """Reward mapped to (0, 1) as callers see it."""
    rows = live(steps_of(spark, sf_dir))
    shown = clamp(F.round((F.col("reward") + 1) / F.lit("2").cast("decimal(2,0)"), 4))
    return rows.select("episode_id", "event_id", "step_no", dbl(F.col("reward"), "reward"),
                       dbl(shown, "external_reward"))


def breakdown(spark, sf_dir):
    """Step total with its non-zero parts as text."""
    rows = live(steps_of(spark, sf_dir))
    parts = F.filter(F.array(*[
        F.when(F.col(p) != 0, F.concat(F.lit(p + "="), F.format_string("%.4f", F.col(p).cast("double"))))
        for p in PARTS]), lambda x: x.isNotNull())
    return rows.select("episode_id", "event_id", "step_no", dbl(F.col("reward"), "reward"),
                       F.array_join(parts, ";").alias("breakdown"))


def progress(spark, sf_dir):
    """Per episode: score history in step order, best score, remaining budget."""
    rows = live(steps_of(spark, sf_dir))
    history = F.transform(F.array_sort(F.collect_list(F.struct("step_no", "perf_score"))),
                          lambda x: F.format_string("%.4f", x["perf_score"].cast("double")))
    return rows.groupBy("episode_id").agg(
        F.array_join(history, ",").alias("history"),
        F.max("best_perf").cast("double").alias("best_score"),
        F.greatest(F.lit(0), F.lit(dims.MAX_STEPS) - F.max("step_no")).alias("budget_remaining"),
        F.sum("reward").cast("double").alias("total_reward"))


def latest_state(spark, sf_dir):
    """Last live row of an episode and how often each action was taken."""
    rows = live(steps_of(spark, sf_dir))
    counts = rows.groupBy("episode_id", "action_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("step_no", "event_id", "reward", F.col("action_type").alias("last_action"))).alias("last"))
    return counts.groupBy("episode_id").agg(
        F.max("last").alias("l"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "action_type", "n"))), ";").alias("action_counts")
    ).select("episode_id", F.col("l.step_no").alias("step_count"), F.col("l.event_id").alias("last_event"),
             F.col("l.last_action").alias("last_action"), dbl(F.col("l.reward"), "last_reward"), "action_counts")


def run_score(spark, sf_dir):
    """Score of the first ten steps: clamp(sum / 10), success from 0.5."""
    rows = live(steps_of(spark, sf_dir)).where("step_no <= 10")
    agg = rows.groupBy("episode_id").agg(F.count(F.lit(1)).alias("steps"), F.sum("reward").alias("s"))
    score = F.greatest(F.lit(0).cast(DEC), F.least(F.lit(1).cast(DEC), F.round(F.col("s") / 10, 4)))
    return agg.select("episode_id", "steps", dbl(score, "score"), (score >= 0.5).alias("success"))


def best_so_far(spark, sf_dir):
    """Running best score over the whole history and whether the target is met."""
    rows = scan.running(steps_of(spark, sf_dir), "episode_id", ("ts", "event_id"), {
        "step_no": ("sum", F.lit(1).cast("bigint")), "best_perf": ("max", F.col("perf_score"))})
    return rows.select("episode_id", "event_id", "step_no", dbl(F.col("best_perf"), "best_score"),
                       (F.col("perf_score") >= dims.DEFAULT_TARGET).alias("target_reached"))


def reward_stats(spark, sf_dir):
    """Average, maximum and minimum step reward, steps and episodes."""
    rows = live(steps_of(spark, sf_dir))
    per = rows.groupBy("episode_id").agg(F.sum("reward").alias("s"), F.count(F.lit(1)).alias("n"),
                                         F.max("reward").alias("hi"), F.min("reward").alias("lo"))
    return per.agg((F.sum("s").cast("double") / F.sum("n")).alias("avg_reward"),
                   F.max("hi").cast("double").alias("max_reward"),
                   F.min("lo").cast("double").alias("min_reward"),
                   F.sum("n").alias("steps"), F.count(F.lit(1)).alias("episodes"))


def valid_series(spark, sf_dir):
    """First and last reward above the floor per episode."""
    rows = live(steps_of(spark, sf_dir)).where(F.col("reward") > F.lit("0.001").cast(DEC))
    return rows.groupBy("episode_id").agg(
        F.min_by("reward", "step_no").cast("double").alias("first_reward"),
        F.max_by("reward", "step_no").cast("double").alias("last_reward"),
        F.count(F.lit(1)).alias("valid_steps"))


QUERIES = {
    "E1_step_reward": _ledger_query("action_type", "step_reward"),
    "E2_score_delta": _ledger_query("perf_score", "delta"),
    "E3_delta_reward": _ledger_query("delta", "delta_reward"),
    "E4_milestones": _ledger_query("baseline", "perf_score", "milestone_bonus", "milestones"),
    "E5_loop_penalty": _ledger_query("action_type", "run_pos", "loop_penalty"),
    "E6_hint_penalty": _ledger_query("hints_used", "hint_penalty"),
    "E7_backtrack_penalty": _ledger_query("delta", "backtrack_penalty"),
    "E8_budget_penalty": _ledger_query("is_terminal", "budget_penalty"),
    "E9_efficiency_bonus": _ledger_query("action_type", "efficiency_bonus"),
    "E10_terminal_score": _ledger_query("action_type", "terminal_score"),
    "E11_grader_part": _ledger_query("action_type", "grade", "grader_part"),
    "E12_step_total": breakdown,
    "E13_running_total": _ledger_query("reward", "total_reward"),
    "E14_external_reward": external_reward,
    "E15_done": _ledger_query("done"),
    "E16_truncate_after_done": _ledger_query("action_type", "done"),
    "E17_episode_summary": lambda spark, sf_dir: summary(steps_of(spark, sf_dir)),
    "E18_progress": progress,
    "E19_latest_state": latest_state,
    "E22_run_score": run_score,
    "W16_best_so_far": best_so_far,
    "M7_reward_stats": reward_stats,
    "M8_valid_series": valid_series,
}
