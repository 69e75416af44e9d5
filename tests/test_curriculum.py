"""Tier walk: golden sequences, brute force, and the segmented path for huge learners."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tunewright import kernels
from tunewright.operators import curriculum

START = datetime(2024, 1, 1)


def scores(spark, per_learner):
    out, n = [], 0
    for learner, values in per_learner.items():
        for i, v in enumerate(values):
            out.append((learner, n, START + timedelta(minutes=i), Decimal(str(v))))
            n += 1
    return spark.createDataFrame(out, "learner_id bigint, event_id bigint, ts timestamp_ntz, score decimal(6,4)")


def brute(values):
    tier, seen, out = 0, [], []
    for v in values:
        seen.append(Decimal(str(v)))
        if len(seen) >= 5:
            mean = sum(seen[-5:]) / 5
            if mean >= Decimal("0.75") and tier < 3:
                tier += 1
            elif mean < Decimal("0.30") and tier > 0:
                tier -= 1
        out.append(tier)
    return out


def walked(df, min_rows=None):
    got = {}
    for r in curriculum.walk(df, min_rows).orderBy("learner_id", "episode_no").collect():
        got.setdefault(r.learner_id, []).append((r.episode_no, r.tier))
    return got


@pytest.mark.parametrize("values,tiers", [
    ([.8] * 7, [0, 0, 0, 0, 1, 2, 3]),
    ([.8] * 9, [0, 0, 0, 0, 1, 2, 3, 3, 3]),
    ([.8] * 5 + [.1] * 5, [0, 0, 0, 0, 1, 1, 1, 1, 0, 0]),
])
def test_golden_walks(spark, values, tiers):
    assert [t for _, t in walked(scores(spark, {1: values}))[1]] == tiers


@pytest.mark.parametrize("min_rows", [None, 7, 40])
def test_segmented_equals_brute_force(spark, min_rows):
    rng = random.Random(11)
    data = {}
    for learner in range(12):
        level, values = 0.5, []
        for _ in range(rng.choice([3, 20, 300])):
            level = min(0.97, max(0.02, level + rng.uniform(-0.3, 0.3)))
            values.append(round(level, 4))
        data[learner] = values
    got = walked(scores(spark, data), min_rows)
    assert got == {k: list(enumerate(brute(v), 1)) for k, v in data.items()}


def test_bursty_learner(spark):
    """Most rows share one instant: segments are uneven, the result is the same."""
    values = [.9, .8, .95, .7, .1, .2, .05, .1, .2, .3] * 8
    df = scores(spark, {1: values}).withColumn(
        "ts", F.expr("CASE WHEN event_id BETWEEN 10 AND 60 THEN timestamp_ntz'2024-01-01 00:10:00' ELSE ts END"))
    assert [t for _, t in walked(df, 5)[1]] == brute(values)


def test_tier_range(spark, sf):
    got = curriculum.walk(curriculum.scores_of(spark, sf)).selectExpr("min(tier) AS lo", "max(tier) AS hi").first()
    assert got.lo >= 0 and got.hi <= 3


@pytest.mark.parametrize("seed", range(5))
def test_scan_of_clamp_maps_is_the_fold(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    add, low = rng.integers(-2, 3, n), rng.integers(0, 2, n)
    high = low + rng.integers(0, 4, n)
    a, lo, hi = kernels.clamp_scan(add, low, high)
    for start in (0, 1, 3):
        x = start
        for k in range(n):
            x = min(high[k], max(low[k], x + add[k]))
            assert min(hi[k], max(lo[k], start + a[k])) == x


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_walk_with_one_key_on_a_third_of_the_rows(size):
    """Runs go on over batch borders; starts, effects and walks agree with the fold."""
    rng = np.random.default_rng(size)
    keys = np.sort(np.where(rng.random(2400) < 1 / 3, 50, rng.integers(0, 100, 2400)))
    rows = pd.DataFrame({"learner_id": keys, "seg": 0, "shift": rng.integers(-1, 2, 2400), "start_tier": np.where(keys % 2, 2, 0)})
    cut = [rows.iloc[k:k + size] for k in range(0, len(rows), size)]
    got = pd.concat(kernels.tier_walk(iter(cut)))
    effects = pd.concat(kernels.segment_effect(iter(cut))).astype("int64").set_index("learner_id")
    for key, group in rows.groupby("learner_id"):
        x, tiers = group.start_tier.iloc[0], []
        for step in group["shift"]:
            x = min(3, max(0, x + step))
            tiers.append(x)
        mine = got[got.learner_id == key]
        assert mine.tier.tolist() == tiers and mine.tier_before.tolist() == [group.start_tier.iloc[0]] + tiers[:-1]
        e = effects.loc[key]
        assert e.n == len(group) and min(e.high, max(e.low, group.start_tier.iloc[0] + e["add"])) == tiers[-1]
