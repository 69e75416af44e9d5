"""Streaming results equal the batch results, whatever the order of the files and the size of the batches."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tunewright import dims, kernels, views
from tunewright.operators import curriculum, ledger
from tunewright.session import shared_dir, table
from tunewright.streaming import episodes

ORDERS = {"reversed": (3, 2, 1, 0), "mixed": (2, 0, 3, 1)}


@pytest.fixture(scope="module", params=list(ORDERS))
def arriving(request, spark, sf):
    """Folder whose events are files that arrive (by modification time) in the given order."""
    folder, order = shared_dir(spark, "arriving"), ORDERS[request.param]
    e = table(spark, sf, "events")
    size = e.count() // len(order) + 1
    for k in order:
        e.where((F.col("event_id") >= k * size) & (F.col("event_id") < (k + 1) * size)).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        time.sleep(0.02)
    return folder


@pytest.mark.parametrize("files", [1, 2])
def test_steps(spark, sf, arriving, as_rows, files):
    got = episodes.scored_steps(spark, arriving, maxFilesPerTrigger=files)
    live = ledger.live(ledger.steps_of(spark, sf)).selectExpr(
        "episode_id", "event_id", "step_no", "CAST(reward AS DOUBLE)", "CAST(total_reward AS DOUBLE)", "done")
    assert as_rows(got) == as_rows(live)


def test_tiers(spark, sf, arriving, as_rows):
    got = episodes.tiers(spark, arriving, maxFilesPerTrigger=1)
    batch = curriculum.walk(curriculum.scores_of(spark, sf)).select("learner_id", "event_id", "episode_no", "tier")
    assert as_rows(got) == as_rows(batch)


def test_counts(spark, sf, arriving, as_rows):
    got = episodes.action_counts(spark, arriving, maxFilesPerTrigger=1)
    batch = (table(spark, sf, "events").selectExpr(*views.EPISODE_STEP)
             .groupBy(F.unix_seconds(F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("w"), "action_type").count())
    assert as_rows(got) == as_rows(batch)


def test_rules_are_exact():
    r = episodes.rules()
    assert r["step"]["optimize_query"] == 2000 and r["milestones"] == [(25, 1500), (50, 2500), (75, 4000)]
    assert set(r["step"]) == set(dims.ACTIONS)


class _State:
    """Value and map state of one key in plain memory, and the timers it sets."""

    def __init__(self):
        self.values, self.maps, self.timers = {}, {}, set()

    def getValueState(self, name, schema):
        values = self.values

        class Value:
            exists = staticmethod(lambda: name in values)
            get = staticmethod(lambda: values[name])
            update = staticmethod(lambda v: values.__setitem__(name, v))
        return Value()

    def getMapState(self, name, key_schema, schema):
        pages = self.maps.setdefault(name, {})

        class Map:
            getValue = staticmethod(lambda k: pages[k])
            updateValue = staticmethod(pages.__setitem__)
        return Map()

    def registerTimer(self, at):
        self.timers.add(at)


@pytest.mark.parametrize("seed", range(6))
def test_pages_of_any_arrival(seed):
    """Scores in any order and of any trigger size: every place of the history ends up as the fold has it."""
    rng = random.Random(seed)
    rows = [(rng.randrange(60), k, rng.choice((500, 2500, 5000, 7600, 9000))) for k in range(80)]
    arriving = rows[:] if seed else sorted(rows)
    if seed:
        rng.shuffle(arriving)
    state, at, slots, emitted = _State(), 0, {}, 0
    processor = kernels.tier_processor(episodes.tier_rules(), chunk=4)
    processor.init(state)
    while at < len(arriving):
        size = rng.randrange(1, 12)
        part = pd.DataFrame(arriving[at:at + size], columns=["us", "event_id", "score"])
        at += size
        for out in processor.handleInputRows((7,), iter([part.iloc[:2], part.iloc[2:]]), None):
            emitted += len(out)
            for r in out.itertuples(index=False):
                assert slots.get(r.episode_no, (0, 0, -1))[2] < r.version
                slots[r.episode_no] = (r.event_id, r.tier, r.version)
    tier, seen, want = 0, [], []
    for _, event, score in sorted(rows):
        seen.append(score)
        if len(seen) >= 5:
            total = sum(seen[-5:])
            tier = min(3, tier + 1) if total >= 37_500 else max(0, tier - 1) if total < 15_000 else tier
        want.append((event, tier))
    assert [slots[k + 1][:2] for k in range(len(rows))] == want
    assert max(len(p[0]) for p in state.maps["pages"].values()) <= 4
    if not seed:  # scores that come in order are only emitted once
        assert emitted == len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_sessions_of_a_group_of_users(seed):
    """Several users share a key: one call and at most one new timer a trigger, and the runs are those of each user alone."""
    rng, gap_ms = random.Random(seed), 10
    rows = [(rng.choice((3, 5, 1 << 40)), k, rng.randrange(400_000)) for k in range(120)]
    rows.sort(key=lambda r: r[2] + rng.randrange(60_000))
    state, mark, closed, latest, late, calls = _State(), 0, [], {}, set(), 0
    processor = kernels.session_processor(gap_ms)
    processor.init(state)
    timer_values = type("T", (), {"getCurrentWatermarkInMs": staticmethod(lambda: mark)})

    def keep(frames):
        for r in pd.concat(frames).itertuples(index=False) if frames else ():
            if r.kind == "late":
                late.add(r.event_id)
            elif r.kind == "closed":
                closed.append((r.user_id, r.lo, r.hi, r.n))
            else:
                version, runs = latest.get(r.user_id, (0, []))
                latest[r.user_id] = (r.version, (runs if r.version == version else []) + [(r.user_id, r.lo, r.hi, r.n)] * (r.n > 0))
    for first in range(0, len(rows), 15):
        part = pd.DataFrame(rows[first:first + 15], columns=["user_id", "event_id", "us"])
        before = len(state.timers)
        keep(list(processor.handleInputRows((7,), iter([part.iloc[:4], part.iloc[4:]]), timer_values)))
        assert len(state.timers) <= before + 1
        mark = max(mark, max(r[2] for r in rows[:first + 15]) // 1000 - 30)
        for at in sorted(t for t in state.timers if t <= mark):
            state.timers.discard(at)
            keep(list(processor.handleExpiredTimer((7,), timer_values, None)))
    want = []
    for user, event, us in sorted((u, e, t) for u, e, t in rows if e not in late):
        want.append((user, us))
    runs = []
    for user, us in sorted(want):
        if runs and runs[-1][0] == user and us - runs[-1][2] < gap_ms * 1000:
            runs[-1] = (user, runs[-1][1], us, runs[-1][3] + 1)
        else:
            runs.append((user, us, us, 1))
    assert closed and sorted(closed + [r for _, v in latest.values() for r in v]) == runs


def test_sessions_without_a_user(spark, tmp_path, as_rows):
    """Rows without a user are a group of their own, and their late rows are told too."""
    rows = [(None if k % 3 else k % 2, k, 3_600 * (k if k % 10 else max(0, k - 15))) for k in range(60)]
    e = spark.createDataFrame(rows, "user_id bigint, event_id bigint, s bigint").selectExpr("event_id", "CAST(timestamp_seconds(s) AS TIMESTAMP_NTZ) AS ts", "user_id")
    e.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = episodes.delivered(spark, str(tmp_path), 0.05)
    seen = got.where("kind = 'late'").count() + got.where("kind = 'closed'").agg(F.sum("n")).first()[0]
    left = {}
    for r in got.where("kind = 'open'").collect():
        if r.version >= left.get(r.user_id, (0, 0))[0]:
            n = left[r.user_id][1] if left.get(r.user_id, (0, 0))[0] == r.version else 0
            left[r.user_id] = (r.version, n + r.n)
    assert None in left and seen + sum(n for _, n in left.values()) == len(rows)


def test_sessions_and_late_rows_account_for_every_event(spark, sf, as_rows):
    """What is late goes aside, the rest makes the runs that a batch job makes of it."""
    rows = episodes.delivered(spark, sf, 0.05)
    late = rows.where("kind = 'late'").select("event_id")
    closed, left = rows.where("kind = 'closed'"), episodes.newest(rows.where("kind = 'open'"), "user_id", "version").where("n > 0")
    events = table(spark, sf, "events")
    assert late.count() > 0 and closed.count() > 0
    assert late.count() + closed.unionByName(left.withColumn("version", F.lit(0)).select(closed.columns)).agg(F.sum("n")).first()[0] == events.count()
    on_time = shared_dir(spark, "on-time")
    events.join(late, "event_id", "left_anti").write.parquet(f"{on_time}/events.parquet")
    got = closed.select("user_id", "lo", "hi", "n").unionByName(left.select("user_id", "lo", "hi", "n"))
    want = curriculum.idle_sessions(spark, on_time)
    assert as_rows(got.selectExpr("user_id", "n", "hi - lo")) == as_rows(want.select("user_id", "n_events", "length_us"))


def test_sessions_equal_the_batch_form(spark, sf, as_rows):
    assert as_rows(episodes.sessions(spark, sf)) == as_rows(curriculum.idle_sessions(spark, sf))


def test_no_other_name_is_read(spark, sf, tmp_path):
    """A table folder beside one whose name begins alike."""
    e = table(spark, sf, "events")
    e.limit(50).write.parquet(f"{tmp_path}/events.parquet")
    e.write.parquet(f"{tmp_path}/events.parquet_old")
    assert episodes.tiers(spark, str(tmp_path)).count() == 50
