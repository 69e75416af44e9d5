"""Golden rewards, a plain Python replay and invariants of the reward ledger."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tunewright import dims, kernels
from tunewright.operators import ledger
from tunewright.streaming.episodes import rules

START = datetime(2024, 1, 1)
SCHEMA = "episode_id bigint, event_id bigint, ts timestamp_ntz, action_type string, perf_score decimal(12,4)"


def log(spark, episodes):
    """episodes: {id: [(action, perf), ...]}"""
    out, n = [], 0
    for episode, steps in episodes.items():
        for i, (action, perf) in enumerate(steps):
            out.append((episode, n, START + timedelta(seconds=i), action, Decimal(str(perf))))
            n += 1
    return spark.createDataFrame(out, SCHEMA)


def rewards(spark, steps, **options):
    got = ledger.ledger(log(spark, {1: steps}), graded=False, **options).orderBy("step_no").collect()
    return [float(r.reward) for r in got]


@pytest.mark.parametrize("steps,expected", [
    ([("inspect_query", 40), ("inspect_query", 40)], [0.05, 0.001]),
    ([("request_hint", 40)], [0.001]),
    ([("inspect_query", 0), ("create_index", 20)], [0.05, 0.18]),
    ([("inspect_query", 40), ("create_index", 35)], [0.05, 0.03]),
    ([("inspect_query", 40), ("create_index", 70)], [0.05, round(0.10 + 0.12 + 0.40, 4)]),
])
def test_golden_rewards(spark, steps, expected):
    assert rewards(spark, steps) == expected


def test_report_after_paid_milestones(spark):
    actions = ["inspect_query", "create_index"] + ["inspect_query", "analyze_indexes"] * 3 + ["inspect_query", "submit_report"]
    steps = [(a, 40 if i == 0 else 70) for i, a in enumerate(actions)]
    assert rewards(spark, steps)[9] == 0.64


def test_budget_penalty_and_length(spark):
    steps = [("inspect_query" if i % 2 else "partition_table", 10) for i in range(70)]
    got = rewards(spark, steps)
    assert len(got) == dims.MAX_STEPS
    assert got[48] == 0.001 and got[46] == 0.15  # partition_table at steps 49 and 47


def replay(steps):
    state, out = [0, 0, 0, 0, None, 0, False, None], []
    for action, perf in steps[:50]:
        out.append(kernels.score_step(state, action, int(Decimal(str(perf)) * 10000), None, rules()))
    return [x / 10000 for x in out]


def test_matches_step_kernel_on_random_episodes(spark):
    rng = random.Random(5)
    actions = [a for a in dims.ACTIONS if a not in dims.GRADE_SHARE] + ["unheard_of"]
    episodes = {e: [(rng.choice(actions[:4] if e % 2 else actions), round(rng.uniform(0, 99), 3)) for _ in range(rng.randint(1, 60))]
                for e in range(40)}
    got = ledger.ledger(log(spark, episodes), graded=False).orderBy("episode_id", "step_no").collect()
    by_episode = {}
    for r in got:
        by_episode.setdefault(r.episode_id, []).append(float(r.reward))
    assert by_episode == {e: replay(s) for e, s in episodes.items()}


def test_invariants(spark, sf):
    led = ledger.ledger(ledger.steps_of(spark, sf)).cache()
    assert led.where("reward < 0.001 OR reward > 0.999").count() == 0
    paid = (led.where("milestones <> ''").select("episode_id", F.explode(F.split("milestones", ",")).alias("m"))
            .groupBy("episode_id", "m").count().where("count > 1").count())
    assert paid == 0
    live = led.where("NOT finished_before")
    assert live.where("done").groupBy("episode_id").count().where("count > 1").count() == 0
    led.unpersist()


def test_one_exchange_and_map_side_limit(spark, sf):
    plan = ledger.summary(ledger.steps_of(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_episode_ships_few_rows(spark):
    steps = spark.range(200_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS episode_id", "id AS event_id",
        "timestamp_ntz'2024-01-01 00:00:00' AS ts", "'inspect_query' AS action_type", "CAST(10 AS DECIMAL(12,4)) AS perf_score")
    got = ledger.episode_log(steps).groupBy("episode_id").count()
    assert got.where("episode_id = 7").first()["count"] == 50
    assert got.agg(F.max("count")).first()[0] == 50
