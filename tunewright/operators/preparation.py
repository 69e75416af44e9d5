"""Prompts, parsed model answers, expert plans, trajectories and SQL repair."""

from functools import reduce

from pyspark.sql import functions as F

from tunewright import dims, kernels, views
from tunewright.functions import credit
from tunewright.functions.text import clamp, dbl, fingerprint, strip
from tunewright.operators import ledger
from tunewright.operators.grading import scenario_facts, split_columns, with_action_grade
from tunewright.operators.workload import catalog_table, query_log, wanted_table
from tunewright.session import table

DEC = "decimal(18,4)"

# ---------------------------------------------------------------- fixed values
STATE_HEAD = "=== DATABASE STATE ==="
ASK = "What is your next action? JSON only:"
CASE_PROMPT = ("Task: %s\nBuggy Query:\n%s\nError Message:\n%s\nDatabase Schema:\n%s\nCategory: %s\n"
               "Analyze the buggy query and provide your fix as a JSON object.")
STEP_PROMPT = ("You are a senior database engineer.\nCurrent DB state:\n- Performance score: %s / 85\n"
               "- Steps remaining: %d\nChoose the best next action as JSON:")
# ------------------------------------------------------------ end fixed values


def scenario_prompts(spark, sf_dir):
    """Prompt per user: tables, every statement template with its slowest execution, missing layouts, performance.

    The log is reduced to (user, template) before any text is built, so a user
    that owns a third of it costs as many rows as there are templates.
    """
    log = query_log(spark, sf_dir).withColumn("template", fingerprint(F.col("sql_text")))
    slow = F.struct(F.col("exec_ms").alias("ms"), (-F.col("query_id")).alias("last"), F.col("sql_text").alias("sql"))
    per = log.groupBy("user_id", "template", "main_table").agg(F.max(slow).alias("top"), F.count(F.lit(1)).alias("n"), F.sum("exec_ms").alias("s"))
    sizes = catalog_table(spark, sf_dir).select(F.col("name").alias("main_table"), "row_count")
    wanted = wanted_table(spark).groupBy(F.col("layout_table").alias("main_table")).agg(F.array_sort(F.collect_list("layout_columns")).alias("columns"))
    per = per.join(sizes, "main_table", "left").join(wanted, "main_table", "left")
    item = F.struct((-F.col("top.ms")).alias("o"), F.col("template").alias("k"), F.col("top.sql").alias("sql"), F.col("top.ms").alias("ms"),
                    F.col("main_table").alias("main_table"), "row_count", "columns")
    per = per.groupBy("user_id").agg(F.array_sort(F.collect_list(item)).alias("qs"), F.sum("s").alias("s"), F.sum("n").alias("n"))
    queries = F.transform("qs", lambda x, i: F.struct(F.concat(F.lit("q"), i + 1).alias("id"), x["sql"].alias("sql"), x["ms"].alias("ms"), x["main_table"].alias("main_table")))
    tables = F.array_sort(F.array_distinct(F.transform("qs", lambda x: F.struct(x["main_table"].alias("name"), x["row_count"].cast("bigint").alias("rows")))))
    every = F.flatten(F.transform(F.filter("qs", lambda x: x["columns"].isNotNull()),
                                  lambda x: F.transform(x["columns"], lambda c: F.struct(x["main_table"].alias("table"), c.alias("columns")))))
    hints = F.array_sort(F.array_distinct(every))
    mean = F.format_string("%.2f", F.round(F.col("s").cast("decimal(38,4)") / F.col("n"), 2).cast("double"))
    return per.select("user_id", F.concat_ws(
        "\n", F.lit(dims.SYSTEM_INSTRUCTION), F.lit(STATE_HEAD),
        F.concat(F.lit("Scenario: user "), F.col("user_id")),
        F.concat(F.lit("Tables: "), F.to_json(tables)),
        F.concat(F.lit("Slow Queries: "), F.to_json(queries)),
        F.concat(F.lit("Missing Index Hints: "), F.to_json(hints)),
        F.concat(F.lit("Performance: mean "), mean, F.lit(f" ms, target score {dims.DEFAULT_TARGET}")),
        F.lit(ASK)).alias("prompt"))


def case_prompts(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*views.REPAIR)
    schema = F.to_json(F.create_map(F.lit("users"), F.array(F.lit("id INT"), F.lit("name VARCHAR(100)"))))
    return rows.select("event_id", F.format_string(
        CASE_PROMPT, F.concat(F.lit("repair "), F.col("event_id")), F.col("buggy_query"), F.col("error_message"), schema,
        F.col("category")).alias("prompt"))


def extract_action(df, text):
    """Add action_json (NULL when there is none) and action_type.

    Fences are removed and the whole text is tried first, all inside the JVM;
    only what is left goes through the Arrow kernel that searches for an object.
    """
    fence = "```"
    plain = strip(F.when(F.contains(text, F.lit(fence)), F.regexp_replace(text, f"{fence}(json)?", "")).otherwise(text))
    df = df.withColumn("_plain", plain).withColumn("_whole", F.try_parse_json("_plain"))
    clean = F.try_variant_get("_whole", "$.action_type", "string").isNotNull()
    search = F.pandas_udf(kernels.action_json, "string")
    df = df.withColumn("_clean", F.coalesce(clean, F.lit(False)))
    df = df.withColumn("_found", search(F.when(~F.col("_clean"), F.col("_plain"))))
    df = df.withColumn("action_json", F.when(F.col("_clean"), F.col("_plain")).otherwise(F.col("_found")))
    return df.withColumn("action_type", F.get_json_object("action_json", "$.action_type")).drop(
        "_plain", "_whole", "_clean", "_found")


def extracted(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*views.COMPLETION)
    return extract_action(rows, F.col("completion"))


def with_payload(df):
    """Payload fields of action_json as columns; columns may be a list or a comma text."""
    v = F.try_parse_json("action_json")

    def field(name):
        return F.try_variant_get(v, f"$.payload.{name}", "string")
    listed = F.try_variant_get(v, "$.payload.columns", "array<string>")
    return (df.withColumn("table_name", field("table")).withColumn("query_id", field("query_id"))
            .withColumn("new_sql", field("new_sql"))
            .withColumn("cols", F.coalesce(listed, split_columns(field("columns")))))


def action_extraction(spark, sf_dir):
    rows = with_payload(extracted(spark, sf_dir))
    return rows.select("completion_id", F.when(F.col("action_json").isNotNull(), "accepted").otherwise("quarantine").alias("route"),
                       "action_type", "table_name", F.array_join("cols", ",").alias("columns"))


def action_defaults(spark, sf_dir):
    """Answers with missing fields filled; text that is no JSON becomes identify_error."""
    rows = table(spark, sf_dir, "events").selectExpr(*views.ANSWER)
    # the first fenced part counts, without its language tag
    fenced = F.regexp_replace(F.try_element_at(F.split("answer", "```"), F.lit(2)), "^json", "")
    rows = rows.withColumn("plain", strip(F.coalesce(fenced, F.col("answer"))))
    rows = rows.withColumn("v", F.try_parse_json("plain"))

    def get(name, kind="string"):
        return F.try_variant_get("v", f"$.{name}", kind)
    number = get("confidence", "double")
    broken = (F.col("v").isNull() | ~F.startswith("plain", F.lit("{"))
              | (get("confidence").isNotNull() & number.isNull()))
    optimise = F.coalesce(get("action_type"), F.lit("submit_answer")) == "optimize_query"
    return rows.select(
        "event_id",
        F.when(broken, "identify_error").when(optimise, "optimize_query").otherwise("submit_answer").alias("action_type"),
        F.when(broken, F.lit(None)).when(optimise, F.coalesce(get("optimized_query"), F.lit("SELECT 1")))
        .otherwise(F.coalesce(get("fixed_query"), F.lit("SELECT 1"))).alias("query"),
        F.when(broken, "LLM call failed, using fallback").otherwise(F.coalesce(get("explanation"), F.lit(""))).alias("explanation"),
        F.when(optimise & ~broken, F.coalesce(get("optimization_type"), F.lit("Performance fix")))
        .otherwise(F.coalesce(get("error_type"), F.lit("syntax"))).alias("kind"),
        F.when(optimise & ~broken, F.lit(None)).otherwise(F.coalesce(get("error_location"), F.lit("unknown"))).alias("error_location"),
        F.when(optimise & ~broken, F.coalesce(get("root_cause"), F.lit(""))).alias("root_cause"),
        F.when(optimise & ~broken, F.coalesce(get("expected_improvement"), F.lit(""))).alias("expected_improvement"),
        F.when(~broken, F.coalesce(number, F.lit(0.7))).alias("confidence"))


def expand_plan(df, plan):
    """op:target:arguments strings to numbered steps."""
    rows = df.select("*", F.posexplode(plan).alias("pos", "item"))
    parts = F.split("item", ":", 3)
    return rows.select(*[c for c in df.columns if not c.startswith("plan_")],
                       (F.col("pos") + 1).alias("step"), parts[0].alias("op"),
                       F.try_element_at(parts, F.lit(2)).alias("target"),
                       F.try_element_at(parts, F.lit(3)).alias("argument"))


def plan_steps(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*views.PLAN)
    steps = expand_plan(rows, F.array("plan_1", "plan_2", "plan_3"))
    listed = F.when(F.col("op") == "create_index", F.size(F.split("argument", ","))).otherwise(0)
    return steps.withColumn("n_columns", listed)


def trajectories(spark, sf_dir):
    """Training records: prompt before the step, action, shown reward, score change."""
    rows = ledger.live(ledger.steps_of(spark, sf_dir))
    shown = clamp(F.round((F.col("reward") + 1) / F.lit("2").cast("decimal(2,0)"), 4))
    score = F.format_string("%.2f", F.round(F.coalesce("prev_perf", F.col("baseline")), 2).cast("double"))
    prompt = F.format_string(STEP_PROMPT, score, F.lit(dims.MAX_STEPS + 1) - F.col("step_no"))
    return rows.select("episode_id", F.col("step_no").alias("step"), prompt.alias("prompt"), "action_type",
                       dbl(shown, "reward"), dbl(F.col("delta"), "db_delta"))


def completion_scores(spark, sf_dir):
    """Reward of raw completions: 0.001 no action, 0.05 unknown action, else the grade of the action against its scenario."""
    n = len(dims.SCENARIOS)
    ids = F.array(*[F.lit(s["id"]) for s in dims.SCENARIOS])
    fields = ("partition_column", "index_name", "column_name", "summary")
    v = F.try_parse_json("action_json")
    rows = with_payload(extracted(spark, sf_dir)).select(
        "completion_id", "action_json", "action_type", "table_name", "cols", "query_id", "new_sql",
        *[F.try_variant_get(v, f"$.payload.{f}", "string").alias(f) for f in fields],
        F.element_at(ids, (F.col("completion_id") % n + 1).cast("int")).alias("task_id"))
    graded = with_action_grade(rows, scenario_facts(dims.scenario_table(spark)))
    known = F.coalesce(F.col("action_type").isin(*dims.TRAINER_ACTIONS), F.lit(False))
    return graded.select("completion_id", F.col("task_id").alias("scenario_id"),
                         F.when(F.col("action_json").isNull(), F.lit(0.001)).when(~known, F.lit(0.05))
                         .otherwise(F.col("grade")).alias("reward"))


# ------------------------------------------------------------------ SQL repair

# ---------------------------------------------------------------- fixed values
MISSING_COMMA = (r"(?i)SELECT\s+(\w+)\s+(\w+)", "SELECT $1, $2")
MISSING_BY = ((r"(?i)\bORDER\s+(?!BY)(\w)", "ORDER BY $1"), (r"(?i)\bGROUP\s+(?!BY)(\w)", "GROUP BY $1"))
MISSING_WHERE = ((" id =", " WHERE id ="), (" name =", " WHERE name ="))
AGGREGATE_FILTER = (r"(?i)WHERE\s+(AVG|SUM|COUNT|MAX|MIN)\s*\(", "HAVING $1(")
WIDER_JOIN = (("INNER JOIN", "LEFT JOIN"), ("inner join", "LEFT JOIN"))
NARROW_LIST = ("SELECT *", "SELECT id, name, status, created_at")
# ------------------------------------------------------------ end fixed values


def _replace_all(c, pairs):
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def repaired(query, category, message):
    """Rule-based repair of a buggy statement, by category."""
    q, note = strip(query), F.lower(message)
    names = F.contains(note, F.lit("syntax error")) & F.contains(note, F.lit("name"))
    syntax = F.when(names, F.regexp_replace(q, *MISSING_COMMA)).otherwise(q)
    bare = ~F.contains(F.upper(syntax), F.lit("WHERE")) & F.contains(syntax, F.lit("="))
    syntax = F.when(bare, _replace_all(syntax, MISSING_WHERE)).otherwise(syntax)
    quotes = F.length(syntax) - F.length(F.replace(syntax, F.lit("'"), F.lit("")))
    syntax = F.when(quotes % 2 != 0, F.concat(syntax, F.lit("'"))).otherwise(syntax)
    for rule in MISSING_BY:
        syntax = F.regexp_replace(syntax, *rule)
    logic = F.regexp_replace(_replace_all(q, WIDER_JOIN), *AGGREGATE_FILTER)
    speed = _replace_all(q, (NARROW_LIST,))
    return F.when(category == "syntax", syntax).when(category == "logic", logic).when(category == "performance", speed).otherwise(q)


# ---------------------------------------------------------------- fixed values
LOCATION_RULES = (
    (("SELECT", "COLUMN"), "SELECT clause"),
    (("WHERE", "FILTER"), "WHERE clause"),
    (("JOIN", "ON"), "JOIN condition"),
    (("GROUP", "HAVING"), "GROUP BY / HAVING clause"),
    (("ORDER",), "ORDER BY clause"),
)
SLOW_LOCATION, NO_LOCATION = "Query structure — performance bottleneck", "Unknown location"
FIX_TEXT = {
    "syntax": "Fixed syntax error in the SQL query by correcting the query structure.",
    "logic": "Fixed logic error by correcting the JOIN type and query conditions.",
    "performance": "Optimized query performance by restructuring to avoid expensive operations.",
}
OTHER_FIX, NO_FIX = "Applied heuristic fix to the SQL query.", ("Analyzed the ", " issue. The query may require deeper inspection.")
SLOW_CAUSE, SLOW_GAIN, SLOW_KIND = ("Performance issue detected: ", "Significant reduction in query execution time", "Fix performance issue: performance")
# ------------------------------------------------------------ end fixed values


def guessed_location(message, category):
    up = F.upper(message)
    out = F.when(category == "performance", SLOW_LOCATION).otherwise(NO_LOCATION)
    for words, place in reversed(LOCATION_RULES):
        hit = reduce(lambda a, b: a | b, [F.contains(up, F.lit(w)) for w in words])
        out = F.when(hit, place).otherwise(out)
    return out


def fix_explanation(buggy, fixed, category):
    text = F.create_map(*[F.lit(x) for kv in FIX_TEXT.items() for x in kv])
    base = F.coalesce(F.try_element_at(text, category), F.lit(OTHER_FIX))
    same = F.concat(F.lit(NO_FIX[0]), category, F.lit(NO_FIX[1]))
    return F.when(F.trim(buggy) == F.trim(fixed), same).otherwise(F.concat(
        base, F.lit(" Original: '"), F.left(buggy, F.lit(60)), F.lit("...' Fixed: '"), F.left(fixed, F.lit(60)), F.lit("...'")))


def repairs(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*views.REPAIR, views.REPAIR_TASK)
    c = F.col
    rows = rows.withColumn("fixed_query", repaired(c("buggy_query"), c("category"), c("error_message")))
    rows = rows.withColumn("error_location", guessed_location(c("error_message"), c("category")))
    return rows.withColumn("explanation", fix_explanation(c("buggy_query"), c("fixed_query"), c("category")))


def repair_texts(spark, sf_dir):
    return repairs(spark, sf_dir).select("event_id", "category", "fixed_query")


def repair_locations(spark, sf_dir):
    return repairs(spark, sf_dir).select("event_id", "error_location")


def repair_explanations(spark, sf_dir):
    return repairs(spark, sf_dir).select("event_id", "explanation")


def scoreboard(spark, sf_dir):
    """Mean grade of the rule-based repair per tier."""
    c = F.col
    slow = c("category") == "performance"
    rows = repairs(spark, sf_dir).where("task_id IS NOT NULL").select(
        "event_id", "task_id", F.when(~slow, c("fixed_query")).alias("fixed_query"),
        F.when(slow, c("fixed_query")).alias("optimized_query"), "explanation",
        c("category").alias("error_type"), F.when(~slow, c("error_location")).alias("error_location"),
        F.lit("0.6").alias("confidence"), F.lit(None).cast("string").alias("impact"),
        F.when(slow, F.concat(F.lit(SLOW_CAUSE), F.left("error_message", F.lit(100)))).alias("root_cause"),
        F.when(slow, SLOW_GAIN).alias("expected_improvement"),
        F.when(slow, SLOW_KIND).alias("optimization_type"), F.lit(None).cast("string").alias("change_made"))
    graded = credit.with_case_grade(rows, credit.case_facts(dims.case_table(spark)))
    return graded.groupBy(F.split_part("task_id", F.lit("_"), F.lit(1)).alias("tier")).agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(c("grade").cast(DEC)).cast("double") / F.count(F.lit(1))).alias("mean_grade"))


QUERIES = {
    "T1_scenario_prompt": scenario_prompts,
    "T2_case_prompt": case_prompts,
    "T3_action_extraction": action_extraction,
    "T4_action_defaults": action_defaults,
    "T5_plan_expansion": plan_steps,
    "T6_trajectories": trajectories,
    "T7_completion_scores": completion_scores,
    "T8_sql_repair": repair_texts,
    "T9_error_location": repair_locations,
    "T10_fix_explanation": repair_explanations,
    "T11_repair_scoreboard": scoreboard,
}
