"""Golden grades and properties of the graders."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tunewright import dims
from tunewright.functions import credit
from tunewright.functions.text import clamp, normalize
from tunewright.operators import grading

FIELDS = ("task_id", *credit.ANSWER_FIELDS)


def grade(spark, *answers):
    data = [tuple(a.get(f) for f in FIELDS) for a in answers]
    subs = spark.createDataFrame([(i, *d) for i, d in enumerate(data)],
                                 "n int, " + ", ".join(f"{f} string" for f in FIELDS))
    got = credit.with_case_grade(subs, grading.facts(spark)).orderBy("n").collect()
    return [r.grade for r in got]


EXACT = dict(task_id="easy_001", fixed_query="SELECT id, name, email FROM users WHERE active = 1",
             explanation="Added missing commas between column names in SELECT clause", error_type="syntax",
             error_location="SELECT clause", confidence="0.95")


def test_perfect_easy_answer(spark):
    assert grade(spark, EXACT) == [0.90]


def test_unknown_task_and_empty_answer(spark):
    assert grade(spark, dict(task_id="nonexistent_task_999", fixed_query="SELECT 1"),
                 dict(task_id="easy_001", fixed_query="", explanation="")) == [0.001, 0.001]


def test_case_and_blanks_do_not_matter(spark):
    upper = {**EXACT, "fixed_query": EXACT["fixed_query"].upper()}
    loose = {**EXACT, "fixed_query": "  SELECT   id,  name,  email FROM\tusers  WHERE  active = 1  "}
    assert grade(spark, upper, loose) == [0.90, 0.90]


def test_medium_answer(spark):
    got = grade(spark, dict(task_id="medium_001", fixed_query=dims.CASES[2]["fixed_query"],
                            explanation="Changed INNER JOIN to LEFT JOIN to include users with zero orders",
                            error_type="logic", error_location="JOIN type", confidence="0.9"))
    # fix .40 + three terms .15 + place .15 + explanation .10 + confidence .05
    assert got == [0.85]


def test_hard_answer_partial(spark):
    got = grade(spark, dict(task_id="hard_001", optimized_query="SELECT u.id FROM users u LEFT JOIN orders o ON u.id = o.user_id",
                            optimization_type="Replace N+1 with JOIN", explanation="N+1 pattern detected", confidence="0.5"))
    assert 0.0 < got[0] <= 0.30


def test_not_binary(spark):
    for task in ("easy_001", "medium_001", "hard_001"):
        fixed = next(c["fixed_query"] for c in dims.CASES if c["id"] == task)
        got = grade(spark, dict(task_id=task, fixed_query=fixed, explanation="Fixed", confidence="0.9"),
                    dict(task_id=task, fixed_query="SELECT *", explanation="wrong"), dict(task_id=task, fixed_query="", explanation=""))
        assert len(set(got)) > 1


def sim(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "n int, a string, b string")
    return [r.similarity for r in credit.with_similarity(credit.expect_text(df, F.col("b")), F.col("a")).orderBy("n").collect()]


def test_similarity_identities(spark):
    q = "SELECT id FROM users"
    assert sim(spark, [(q, q), ("", q), (q, ""), ("", ""), (None, q)]) == [1.0, 0.0, 0.0, 1.0, 0.0]


def python_similarity(a, b):
    s, e = (" ".join(x.lower().split()) for x in (a, b))
    if s == e:
        return 1.0
    sw, ew = set(s.split()), set(e.split())
    if not ew:
        return 0.0
    wanted = [k for k in dims.CRITICAL_KEYWORDS if k in e]
    found = sum(k in s for k in wanted)
    return len(sw & ew) / len(ew) * 0.4 + (found / len(wanted) if wanted else 0.0) * 0.6


def test_similarity_against_plain_python(spark):
    words = st.sampled_from(["select", "FROM", "a", "b", "where", "left", "join", "  ", "\t", "count(*)", "or"])
    texts = st.lists(words, max_size=8).map(" ".join)
    pairs = []

    @settings(max_examples=200, deadline=None)
    @given(texts, texts)
    def gather(a, b):
        pairs.append((a, b))
    gather()
    for (a, b), got in zip(pairs, sim(spark, pairs)):
        assert abs(got - python_similarity(a, b)) <= 0.00005 + 1e-9, (a, b)


def test_normalisation_is_idempotent(spark):
    df = spark.createDataFrame([("  A b\x0b c ",), ("",), (None,)], "t string")
    got = df.select(normalize(F.col("t")).alias("once")).select("once", normalize(F.col("once")).alias("twice")).collect()
    assert [r.once for r in got] == ["a b c", "", ""]
    assert all(r.once == r.twice for r in got)


@pytest.mark.parametrize("value,expected", [("0.9", 0.05), (" 1 ", 0.05), ("1.5", 0.0), ("high", 0.0), (None, 0.0), ("0.5d", 0.0)])
def test_confidence(spark, value, expected):
    df = spark.createDataFrame([(value,)], "c string")
    assert df.select(credit.confidence_credit(F.col("c")).alias("x")).first().x == expected


def action(spark, task, kind, **payload):
    base = dict(query_id=None, table_name=None, cols=None, new_sql=None, partition_column=None, index_name=None,
                column_name=None, summary=None)
    base.update(payload)
    df = spark.createDataFrame([(task, kind, *base.values())],
                               "task_id string, action_type string, query_id string, table_name string, cols array<string>, "
                               "new_sql string, partition_column string, index_name string, column_name string, summary string")
    return grading.with_action_grade(df, grading.scenario_facts(dims.scenario_table(spark))).first().grade


def test_action_grades(spark):
    assert action(spark, "hard_s001", "create_index", table_name="transactions", cols=["customer_id", "amount"]) == 0.85
    assert action(spark, "hard_s001", "partition_table", table_name="audit_log") == 0.65
    assert action(spark, "hard_s001", "partition_table", table_name="audit_log", partition_column="created_at") == 0.75
    assert action(spark, "hard_s001", "partition_table", table_name="customers") == 0.20
    assert action(spark, "easy_s001", "drop_index", table_name="users", index_name="PRIMARY") == 0.001
    assert action(spark, "hard_s999", "create_index", table_name="users") == 0.10
    assert action(spark, "easy_s001", "inspect_query", query_id=" q1 ") == 0.40
    assert action(spark, "easy_s001", None) == 0.001


def test_clamp_range(spark):
    df = spark.range(-3, 4).select(clamp(F.col("id")).cast("double").alias("x"))
    got = [r.x for r in df.collect()]
    assert min(got) == 0.001 and max(got) == 0.999


def test_change_made_stands_in_for_an_explanation(spark):
    case = next(c for c in dims.CASES if c["id"].startswith("easy"))
    fields = {f: None for f in credit.ANSWER_FIELDS}
    said = {"none": {}, "own": {"explanation": "x" * 40}, "change": {"change_made": "x" * 40}, "empty": {"explanation": "", "change_made": "x" * 40}}
    rows = [(k, case["id"], *{**fields, "fixed_query": case["fixed_query"], **v}.values()) for k, v in said.items()]
    frame = spark.createDataFrame(rows, ", ".join(["k string", "task_id string", *[f"{f} string" for f in fields]]))
    got = {r.k: r.grade for r in credit.with_case_grade(frame, grading.facts(spark)).collect()}
    assert got["own"] == got["change"] == got["empty"] == pytest.approx(got["none"] + 0.10)


def test_no_row_is_lost_without_a_task_or_passage(spark, sf):
    from tunewright.session import table

    n = table(spark, sf, "events").count()
    assert grading.error_type(spark, sf).count() == n and grading.similarity(spark, sf).count() == table(spark, sf, "documents").count()
