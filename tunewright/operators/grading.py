"""Batch grading: submissions joined to small ground-truth tables, then plain columns."""

from pyspark.sql import functions as F

from tunewright import dims, views
from tunewright.functions import credit
from tunewright.functions.text import clamp, dbl, round4, strip
from tunewright.operators import ledger
from tunewright.session import table

DEC = "decimal(18,4)"


def passages(spark, sf_dir):
    """Documents with the passage they are graded against, prepared once per passage; a document without one stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("submitted"))
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("expected"))
    n = bench.agg(F.count(F.lit(1))).scalar()
    return docs.join(credit.expect_text(bench, F.col("expected")), F.col("item_id") == F.col("doc_id") % n, "left").drop("item_id")


def similarity(spark, sf_dir):
    rows = credit.with_similarity(passages(spark, sf_dir), F.col("submitted"))
    return rows.select("doc_id", F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def keyword_sets(spark, sf_dir):
    """Critical keywords that occur in a text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"))
    found = F.filter(F.array(*[F.lit(k) for k in dims.CRITICAL_KEYWORDS]), lambda k: F.contains(F.col("t"), k))
    return docs.select("doc_id", F.array_join(found, ",").alias("keywords"), F.size(found).alias("n_keywords"))


def answers(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*views.CASE_SUBMISSION)


def facts(spark):
    return credit.case_facts(dims.case_table(spark))


def error_type(spark, sf_dir):
    rows = answers(spark, sf_dir).join(facts(spark), "task_id", "left")
    return rows.select("event_id", credit.error_type_credit(
        F.col("error_type"), F.col("want_type"), F.col("want_aliases")).alias("credit"))


def location(spark, sf_dir):
    return passages(spark, sf_dir).select(
        "doc_id", credit.location_credit(F.col("submitted"), F.col("expected"), F.col("want_words")).alias("credit"))


def explanation(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", credit.explanation_credit(F.col("text")).alias("credit"))


def confidence(spark, sf_dir):
    return answers(spark, sf_dir).select("event_id", credit.confidence_credit(F.col("confidence")).alias("credit"))


def _tier(tier):
    def run(spark, sf_dir):
        rows = answers(spark, sf_dir).where(F.col("task_id").startswith(tier))
        return credit.with_case_grade(rows, facts(spark)).select("event_id", "task_id", "grade")
    return run


def case_grades(spark, sf_dir):
    return credit.with_case_grade(answers(spark, sf_dir), facts(spark)).select("event_id", "task_id", "grade")


def scenario_facts(scenarios):
    """Names that graders look up per scenario: id, tables (name, rows), queries (ids), hints (table, columns)."""
    return scenarios.select(F.col("id").alias("task_id"), F.transform("tables", lambda t: t["name"]).alias("valid_tables"),
                    F.transform(F.filter("tables", lambda t: t["rows"] > 100_000), lambda t: t["name"]).alias("large_tables"),
                    F.col("queries").alias("valid_queries"), "hints")


def with_action_grade(actions, facts, out="grade"):
    """Grade tuning actions against their scenario.

    actions carries task_id, action_type, query_id, table_name, cols (array),
    new_sql, partition_column, index_name, column_name, summary.
    """
    keep = actions.columns

    def text(name):
        return strip(F.coalesce(F.col(name), F.lit("")))

    rows = actions.join(facts, "task_id", "left").select(
        *keep, *[c for c in facts.columns if c != "task_id"],
        text("query_id").alias("_q"), text("table_name").alias("_t"), text("index_name").alias("_i"),
        F.lower(text("new_sql")).alias("_sql"),
        F.array_distinct(F.col("cols")).alias("_cols"))
    act, q, t, idx, sql = (F.col(c) for c in ("action_type", "_q", "_t", "_i", "_sql"))
    known_table = F.array_contains("valid_tables", t)
    known_query = F.array_contains("valid_queries", q)
    rows = rows.withColumn("_match", F.array_max(F.transform(
        F.filter("hints", lambda h: h["table"] == t),
        lambda h: F.size(F.array_intersect(h["columns"], F.col("_cols"))) / F.size(h["columns"]))))
    best = F.coalesce(F.col("_match"), F.lit(0.0))

    def amount(x):
        return F.lit(x).cast(DEC)

    def pick(*arms, otherwise):
        out = amount(otherwise)
        for cond, value in reversed(arms):
            out = F.when(cond, value if not isinstance(value, str) else amount(value)).otherwise(out)
        return out

    def has(x):
        return F.contains(sql, F.lit(x))

    bonus = (pick((~has("select *"), "0.10"), otherwise="0")
             + pick((has("join") & has("where"), "0.10"), otherwise="0")
             + pick((has("index"), "0.08"), otherwise="0")
             + pick((has("left join") | has("inner join"), "0.05"), otherwise="0"))
    rewrite = F.least(amount("0.65"), pick((known_query, "0.20"), (q != "", "0.05"), otherwise="0.03")
                      + F.when(F.length(sql) > 15, bonus).otherwise(amount("0")))
    n = F.length(text("summary"))
    score = pick(
        (act == "inspect_query", pick((known_query, "0.40"), (q != "", "0.10"), otherwise="0.05")),
        (act == "analyze_indexes", pick((known_table, "0.35"), (t != "", "0.08"), otherwise="0.05")),
        (act == "create_index", pick((~known_table, "0.05"), (F.size("_cols") < 1, "0.10"), (best >= 1, "0.85"),
                                     (best >= 0.5, "0.55"), (F.size("hints") > 0, "0.20"), otherwise="0.35")),
        (act == "rewrite_query", rewrite),
        (act == "partition_table", pick((F.array_contains("large_tables", t) & (text("partition_column") != ""), "0.75"),
                                        (F.array_contains("large_tables", t), "0.65"), (known_table, "0.20"), otherwise="0.05")),
        (act == "analyze_statistics", pick((known_table, "0.30"), otherwise="0.08")),
        (act == "drop_index", pick((known_table & (idx != "") & (idx != "PRIMARY"), "0.25"), (idx == "PRIMARY", "0.001"),
                                   otherwise="0.05")),
        (act == "add_column", pick((known_table & (text("column_name") != ""), "0.25"), otherwise="0.05")),
        (act == "request_hint", "0.10"),
        (act == "submit_report", pick((n >= 100, "0.50"), (n >= 30, "0.30"), (n > 0, "0.15"), otherwise="0.05")),
        otherwise="0.05")
    grade = F.when(act.isNull(), amount("0.001")).when(F.col("valid_tables").isNull(), amount("0.10")).otherwise(clamp(score))
    return rows.select(*keep, grade.cast("double").alias(out))


def split_columns(c):
    """'a, b' -> [a, b]; blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def actions(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*views.ACTION_LOG)
    return rows.withColumn("cols", split_columns(F.col("cols")))


def action_grades(spark, sf_dir):
    return with_action_grade(actions(spark, sf_dir), scenario_facts(dims.scenario_table(spark))).select(
        "event_id", "task_id", "action_type", "grade")


def is_scenario(task_id):
    return F.startswith(F.element_at(F.split(task_id, "_"), -1), F.lit("s"))


def dispatch(spark, sf_dir):
    """Every submission by the grader its task id asks for."""
    cases = case_grades(spark, sf_dir).withColumn("kind", F.lit("case"))
    tuned = action_grades(spark, sf_dir).select("event_id", "task_id", "grade").withColumn("kind", F.lit("scenario"))
    return cases.where(~is_scenario(F.col("task_id"))).unionByName(tuned.where(is_scenario(F.col("task_id"))))


def final_report(spark, sf_dir):
    """Report score per episode from its improvement, its length and the summary text."""
    rows = ledger.live(ledger.steps_of(spark, sf_dir))
    text = next(x for x in views.ACTION_LOG if x.endswith(" AS summary"))
    rows = rows.selectExpr("episode_id", "event_id", "step_no", "perf_score", "baseline", text)
    last = rows.groupBy("episode_id").agg(
        F.max("baseline").cast("double").alias("base"), F.max_by("perf_score", "step_no").cast("double").alias("cur"),
        F.max("step_no").alias("steps"), F.max_by(F.length(F.coalesce("summary", F.lit(""))), "step_no").alias("n"))
    gain = F.greatest(F.lit(0.0), (F.col("cur") - F.col("base")) / F.greatest(F.lit(1.0), F.lit(100.0) - F.col("base")))
    spare = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("steps") / F.lit(50.0))
    full = gain * 0.60 + spare * 0.20 + F.lit(0.10) + F.least(F.col("n") / F.lit(300.0), F.lit(0.10))
    short = F.lit(0.15) + F.least(F.col("n") / F.lit(400.0), F.lit(0.25))
    return last.select("episode_id", dbl(clamp(round4(F.when(F.col("base") == 0, short).otherwise(full))), "report_score"))


def roll_up(spark, sf_dir):
    """Mean grade and number of distinct grades per task, per tier and overall.

    Grades are counted per task first, so the roll-up multiplies a few hundred rows.
    """
    g = dispatch(spark, sf_dir).groupBy("task_id", "grade").agg(F.count(F.lit(1)).alias("k"))
    g = g.withColumn("tier", F.split_part("task_id", F.lit("_"), F.lit(1)))
    total = F.sum(F.col("grade").cast(DEC) * F.col("k").cast("decimal(18,0)"))
    return g.rollup("tier", "task_id").agg(
        F.sum("k").alias("n"), (total.cast("double") / F.sum("k")).alias("mean_grade"),
        F.count_distinct("grade").alias("distinct_grades"))


QUERIES = {
    "G1_query_similarity": similarity,
    "G2_critical_keywords": keyword_sets,
    "G3_error_type": error_type,
    "G4_location": location,
    "G5_explanation": explanation,
    "G6_confidence": confidence,
    "G7_easy_grade": _tier("easy"),
    "G8_medium_grade": _tier("medium"),
    "G9_hard_grade": _tier("hard"),
    "G10_action_grade": action_grades,
    "G11_dispatch": dispatch,
    "G12_final_report": final_report,
    "G13_roll_up": roll_up,
}
