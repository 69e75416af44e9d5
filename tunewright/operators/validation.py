"""Projections, filters and checks on task records, actions and text."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunewright import dims, kernels, views
from tunewright.functions.text import clamp, dbl, round4
from tunewright.operators import ledger, scan, synthesis
from tunewright.operators.grading import is_scenario
from tunewright.operators.preparation import extracted, repairs
from tunewright.session import table

# ---------------------------------------------------------------- fixed values
HINTS = (
    "Hint 1: Start by inspecting your slow queries with inspect_query action.",
    "Hint 2: Use analyze_indexes on tables appearing in slow queries.",
    "Hint 3: Category is 'indexing'. Target score: 85.0.",
)
CASE_HINTS = ("Hint 1: The error is in the ", ".", "Hint 2: This is a ", " error. Category: ", ".", "Hint 3: Fix: ")
TEXT_LIMIT, TEXT_MARK = 5000, "...[truncated]"
# ------------------------------------------------------------ end fixed values


def visible_scenarios(scenarios):
    """What an agent may see of a scenario: wanted indexes and the expert plan stay out."""
    return scenarios.select(F.col("id").alias("scenario_id"), "description", "tables", "slow_queries",
                            "performance_score_baseline", "target_score", "max_steps", "category")


def visible_cases(cases):
    """What an agent may see of a case: no fix, type and impact of the issue, one sample row."""
    issue = F.when(F.col("performance_issue").isNotNull(), F.struct("performance_issue.type", "performance_issue.impact"))
    return cases.select("id", "buggy_query", "error_message", "database_schema", F.col("error_type").alias("error_type_hint"),
                        "category", F.coalesce("estimated_fix_steps", F.lit(5)).alias("estimated_steps"),
                        issue.alias("performance_issue"),
                        F.get_json_object("expected_output", "$[0]").alias("expected_output_sample"))


def case_hint(number, location, kind, category, fix):
    """The k-th hint of a debugging case; numbers past three repeat the last."""
    said = [F.lit(x) for x in CASE_HINTS]
    texts = F.array(F.concat(said[0], location, said[1]), F.concat(said[2], kind, said[3], category, said[4]), F.concat(said[5], fix))
    return F.element_at(texts, F.greatest(F.lit(1), F.least(number, F.lit(3))).cast("int"))


def task_list(scenarios, cases):
    """All tasks with tier and description, scenarios first inside a tier."""
    both = (scenarios.select("id", "description", F.lit(0).alias("ord"))
            .unionByName(cases.select("id", "description", F.lit(1).alias("ord"))))
    tier = F.split_part("id", F.lit("_"), F.lit(1))
    return both.select("id", tier.alias("tier"), "description", "ord", F.lit(",".join(dims.ACTIONS)).alias("actions"))


def redacted(spark, sf_dir):
    """Task record without its answers: allow-list, narrowed struct, first sample only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    truth = table(spark, sf_dir, "labels")
    record = docs.join(truth, "doc_id", "left").select(
        "doc_id", "lang", "source",
        F.struct(F.col("lang").alias("type"), F.col("source").alias("impact"), "quality", "toxic").alias("issue"),
        F.array("source", "lang").alias("expected_output"))
    return record.select("doc_id", "lang", "source",
                         F.to_json(F.struct("issue.type", "issue.impact")).alias("issue"),
                         F.array_join(F.slice("expected_output", 1, 1), ",").alias("sample"))


#: Characters of passages that one automaton holds (some tens of bytes of memory each).
SHARD_CHARS = 2_000_000


def leaks(texts, secrets, shard_chars=SHARD_CHARS):
    """(id, item) pairs where a text contains a secret passage verbatim.

    The passages are dealt into shards of bounded size; an automaton of a shard's
    passages finds all of them in one reading of a text, however frequent their words
    are.  No text and no pair is shuffled.  A shard is one scan of the texts; passages
    come to the driver a shard at a time.
    """
    found, shard, size, kind = [], [], 0, texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, item {secrets.schema['item'].dataType.simpleString()}"

    def scan():
        found.append(texts.select("id", "text").mapInArrow(kernels.passage_finder(list(shard)), schema))
    for row in secrets.where("secret <> ''").select("item", "secret").toLocalIterator():
        if shard and size + len(row["secret"]) > shard_chars:
            scan()
            shard.clear()
            size = 0
        shard.append(tuple(row))
        size += len(row["secret"])
    if shard:
        scan()
    return reduce(DataFrame.unionByName, found) if found else texts.sparkSession.createDataFrame([], schema)


def leak_check(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    secrets = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item"), F.col("text").alias("secret"))
    return leaks(texts, secrets).groupBy(F.col("item").alias("item_id")).agg(F.count(F.lit(1)).alias("n_docs"))


def domain_check(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*views.ACTION_LOG)
    ok = F.col("action_type").isin(*dims.ACTIONS)
    return rows.select("event_id", "action_type", F.when(ok, "accepted").otherwise("quarantine").alias("route"),
                       F.when(~ok, F.lit(0.05)).alias("score"))


def missing_fields(action_type, payload_json):
    """Required payload fields that the payload lacks, sorted, comma-separated."""
    need = F.create_map(*[x for k, v in dims.REQUIRED_FIELDS.items()
                          for x in (F.lit(k), F.array(*[F.lit(f) for f in v]).cast("array<string>"))])
    have = F.coalesce(F.json_object_keys(payload_json), F.array().cast("array<string>"))
    return F.array_join(F.array_sort(F.array_except(F.try_element_at(need, action_type), have)), ",")


def required_fields(spark, sf_dir):
    rows = extracted(spark, sf_dir).where("action_json IS NOT NULL")
    return rows.select("completion_id", "action_type",
                       missing_fields(F.col("action_type"), F.get_json_object("action_json", "$.payload")).alias("missing"))


def shorten(c):
    return F.when(F.length(c) > TEXT_LIMIT, F.concat(F.left(c, F.lit(TEXT_LIMIT)), F.lit(TEXT_MARK))).otherwise(c)


def truncation(spark, sf_dir):
    """Long strings inside a payload map are cut with a mark."""
    docs = table(spark, sf_dir, "documents")
    payload = F.transform_values(F.create_map(F.lit("text"), F.col("text"), F.lit("source"), F.col("source")),
                                 lambda k, v: shorten(v))
    rows = docs.select("doc_id", payload.alias("payload"))
    return rows.select("doc_id", F.length(F.col("payload")["text"]).alias("n"),
                       F.md5(F.col("payload")["text"].cast("binary")).alias("digest"))


def null_actions(spark, sf_dir):
    """A null action takes a step and the floor reward but leaves no history; an unknown one earns the default."""
    steps = ledger.steps_of(spark, sf_dir).withColumn(
        "action_type", F.when(F.col("event_id") % 13 != 0, F.col("action_type")))
    rewards = F.create_map(*[x for k, v in dims.STEP_REWARD.items() for x in (F.lit(k), F.lit(v).cast("decimal(18,4)"))])
    log = scan.running(steps, "episode_id", ("ts", "event_id"), {
        "step_no": ("sum", F.lit(1).cast("bigint")), "history": ("sum", F.col("action_type").isNotNull().cast("bigint"))})
    return log.select("episode_id", "event_id", "step_no",
                      F.when(F.col("action_type").isNull(), F.lit(0.001))
                      .otherwise(F.coalesce(F.try_element_at(rewards, F.col("action_type")).cast("double"), F.lit(float(dims.DEFAULT_STEP)))).alias("reward"),
                      "history")


def clamped(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", dbl(clamp(round4(F.col("value") / 100)), "score"))


def routing(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    ids = (e.selectExpr("event_id", next(x for x in views.ACTION_LOG if x.endswith(" AS task_id")))
           .unionByName(e.selectExpr("event_id", next(x for x in views.CASE_SUBMISSION if x.endswith(" AS task_id")))))
    return ids.select("event_id", "task_id", F.when(is_scenario(F.col("task_id")), "scenario").otherwise("case").alias("kind"),
                      F.split_part("task_id", F.lit("_"), F.lit(1)).alias("tier"))


def lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", "n_name", "r_name"))


def hints(spark, sf_dir):
    """The k-th hint of an episode, the last one repeated."""
    rows = scan.running(ledger.steps_of(spark, sf_dir), "episode_id", ("ts", "event_id"), {
        "hints_used": ("sum", (F.col("action_type") == "request_hint").cast("bigint"))}).where("action_type = 'request_hint'")
    texts = F.array(*[F.lit(h) for h in HINTS])
    return rows.select("episode_id", "event_id", F.col("hints_used").alias("hint_no"),
                       F.element_at(texts, F.least(F.col("hints_used"), F.lit(len(HINTS))).cast("int")).alias("hint"))


def catalogue(spark, sf_dir):
    """Tasks per tier with the actions they allow."""
    p = table(spark, sf_dir, "part")
    tier = F.when(F.col("p_size") <= 15, "easy").when(F.col("p_size") <= 30, "medium").otherwise("hard")
    return (p.groupBy(tier.alias("tier")).agg(
        F.count(F.lit(1)).alias("n_tasks"), F.count_distinct("p_name").alias("n_descriptions"),
        F.max("p_size").cast("bigint").alias("max_size"))
        .withColumn("actions", F.lit(",".join(sorted(dims.ACTIONS)))))


def scenario_records(spark, sf_dir):
    """Tuning tasks of the customers, as task records with their answers."""
    made = synthesis.scenarios(synthesis.seeds_of(spark, sf_dir), "seed", "medium")
    return made.select(
        "id", "tier", F.concat(F.lit("Slow statements of a "), F.col("domain")).alias("description"), "tables", "slow_queries", "missing_index_hints",
        (F.col("baseline_tenths") / 10).alias("performance_score_baseline"), (F.col("target_tenths") / 10).alias("target_score"), "max_steps",
        F.lit("indexing").alias("category"), F.transform("missing_index_hints", lambda h: F.concat(F.lit("create_index:"), h["table"])).alias("optimal_actions"))


def case_records(spark, sf_dir):
    """Debugging tasks from the log of buggy statements, as task records with their answers."""
    r = repairs(spark, sf_dir)
    issue = F.when(F.col("category") == "performance", F.struct(
        F.lit("scan").alias("type"), F.lit("slow").alias("impact"), F.lit(900).cast("bigint").alias("execution_time_buggy_ms"), F.lit(9).cast("bigint").alias("execution_time_fixed_ms")))
    tier = F.when(F.col("category") == "syntax", "easy").when(F.col("category") == "logic", "medium").otherwise("hard")
    return r.select(
        F.concat(tier, F.lit("_"), F.col("event_id")).alias("id"), F.concat(F.lit("Repair a statement of user "), F.col("user_id")).alias("description"),
        "buggy_query", "fixed_query", "error_message", "category", F.col("category").alias("error_type"), "error_location",
        F.create_map(F.lit("events"), F.array(F.lit("event_id BIGINT"))).alias("database_schema"), F.when(F.col("event_id") % 2 == 0, 3).alias("estimated_fix_steps"),
        F.concat(F.lit('[{"k": '), F.col("event_id"), F.lit('}, {"k": 0}]')).alias("expected_output"), issue.alias("performance_issue"), "event_id")


def shown_scenarios(spark, sf_dir):
    """What an agent sees of every tuning task, as JSON text."""
    seen = visible_scenarios(scenario_records(spark, sf_dir))
    return seen.select("scenario_id", "category", F.array_join("tables.name", ",").alias("tables"), F.array_join("slow_queries.sql", ";").alias("statements"),
                       F.array_join(F.array_sort(F.json_object_keys(F.to_json(F.struct(*seen.columns)))), ",").alias("fields"))


def shown_cases(spark, sf_dir):
    """What an agent sees of every debugging task."""
    seen = visible_cases(case_records(spark, sf_dir))
    return seen.select("id", "buggy_query", "error_type_hint", "estimated_steps", F.to_json("performance_issue").alias("issue"), "expected_output_sample",
                       F.lit(",".join(sorted(seen.columns))).alias("fields"))


def case_hints(spark, sf_dir):
    """The hint an agent gets that asks for one for the n-th time, n from 1 to 4, on every debugging task."""
    n = (F.col("event_id") % 4 + 1).cast("int")
    return case_records(spark, sf_dir).select("event_id", n.alias("asked"), case_hint(n, F.col("error_location"), F.col("error_type"), F.col("category"), F.col("fixed_query")).alias("hint"))


def all_tasks(spark, sf_dir):
    """The list of all tasks, scenarios and cases, with tier and description."""
    return task_list(scenario_records(spark, sf_dir), case_records(spark, sf_dir))


QUERIES = {
    "P1_visible_scenarios": shown_scenarios,
    "P1_visible_cases": shown_cases,
    "P10_case_hints": case_hints,
    "P11_task_list": all_tasks,
    "P1_redaction": redacted,
    "P2_leak_check": leak_check,
    "P3_domain_check": domain_check,
    "P4_required_fields": required_fields,
    "P5_truncation": truncation,
    "P6_null_actions": null_actions,
    "P7_clamp": clamped,
    "P8_routing": routing,
    "P9_lookup": lookup,
    "P10_progressive_hint": hints,
    "P11_task_catalogue": catalogue,
}
