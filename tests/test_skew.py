"""A key that owns a third of the rows: results stay exact, groups stay bounded."""

import pytest
from pyspark.sql import functions as F

from tunewright.operators import corpus, curriculum, scan, synthesis
from tunewright.session import shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    """Folder with an events table in which user 7 owns a third of the rows."""
    folder = shared_dir(spark, "skewed")
    (spark.range(60_000).selectExpr(
        "id AS event_id", "CAST(timestamp_seconds(1704067200 + id * 97) AS TIMESTAMP_NTZ) AS ts",
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 900 + 100 END AS user_id",
        "element_at(array('view', 'click', 'signup', 'error', 'purchase'), CAST(id % 5 + 1 AS INT)) AS event_type",
        "CAST((id * 7919) % 49000 AS DOUBLE) / 100 AS value", "concat('{\"k\": ', id % 100, '}') AS props")
     .write.parquet(f"{folder}/events.parquet"))
    return folder


def test_segments_are_balanced(spark, skewed):
    scores = curriculum.scores_of(spark, skewed)
    hot = scan.hot_list(scores, "learner_id", "ts", 1000)
    assert [r.hot_key for r in hot.collect()] == [7]
    sizes = (scan.with_segment(scores, "learner_id", "ts", hot).where("is_hot").groupBy("seg").count()
             .agg(F.max("count"), F.sum("count")).first())
    assert sizes[0] <= 1000 and sizes[1] == 20_000


def test_no_hot_learner_means_no_segments(spark, skewed):
    assert scan.hot_list(curriculum.scores_of(spark, skewed), "learner_id", "ts") is None


def test_walk_is_the_same_with_segments(spark, skewed, as_rows):
    scores = curriculum.scores_of(spark, skewed)
    assert as_rows(curriculum.walk(scores, 1000)) == as_rows(curriculum.walk(scores))


def test_idle_sessions_against_brute_force(spark, skewed):
    gap = 360 * 60 * 1_000_000
    per_user = {}
    for r in spark.read.parquet(f"{skewed}/events.parquet").select("user_id", scan.micros("ts").alias("us")).collect():
        per_user.setdefault(r.user_id, []).append(r.us)
    want = []
    for user, times in per_user.items():
        times.sort()
        session = [times[0]]
        number = 1
        for t in times[1:] + [None]:
            if t is None or t - session[-1] >= gap:
                want.append((user, number, len(session), session[-1] - session[0]))
                number, session = number + 1, []
            if t is not None:
                session.append(t)
    got = [tuple(r) for r in curriculum.idle_sessions(spark, skewed).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("query", [corpus.top_three, synthesis.stratified])
def test_top_k_is_trimmed_before_the_shuffle(spark, sf, query):
    text = query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in text.split("\n") if "WindowGroupLimit" in line and "Partial" in line]
    assert partial


def test_diff_counts_copies(spark):
    many = spark.range(3000).selectExpr("1 AS x")
    got = corpus.result_diff(many.limit(2500), many).collect()
    assert [(r.x, r.side, r.copies) for r in got] == [(1, "missing", 500)]


def test_running_values_are_the_same_with_segments(spark, skewed, as_rows):
    rows = spark.read.parquet(f"{skewed}/events.parquet").select("user_id", "event_id", "ts", "value")
    values = {"nth": ("sum", F.lit(1).cast("bigint")), "best": ("max", F.col("value")), "views": ("sum", (F.col("event_id") % 5 == 0).cast("bigint"))}
    cut, whole = (scan.running(rows, "user_id", ("ts", "event_id"), values, n) for n in (1000, None))
    assert as_rows(cut.select("event_id", *values)) == as_rows(whole.select("event_id", *values))
    assert cut.where("user_id = 7").agg(F.max("nth")).first()[0] == 20_000
