"""Readers and writers for the dataset formats: JSON arrays, JSON lines, run logs."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F


CASE_SCHEMA = """
id string, category string, description string, buggy_query string, fixed_query string, error_message string,
database_schema map<string,array<string>>, expected_output string, actual_buggy_output string, error_type string,
error_location string, fix_description string, estimated_fix_steps int, partial_credit_hints map<string,double>,
scoring_rubric map<string,double>,
performance_issue struct<type:string,impact:string,execution_time_buggy_ms:bigint,execution_time_fixed_ms:bigint,
                         rows_scanned_buggy:bigint,rows_scanned_fixed:bigint>,
frontier_model_expected_score double"""
SCENARIO_SCHEMA = """
id string, description string,
tables array<struct<name:string,rows:bigint,indexes:array<string>,size_mb:bigint>>,
slow_queries array<struct<id:string,sql:string,avg_ms:bigint,main_table:string,rows_examined:bigint>>,
missing_index_hints array<struct<table:string,columns:array<string>,reason:string>>,
performance_score_baseline double, target_score double, max_steps int, optimal_actions array<string>, category string"""


def read_json_array(spark, path, schema):
    """Files that hold one JSON array each; a file is the unit of parallelism."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark, path, schema):
    return spark.read.schema(schema).json(path)


def read_existing(paths, reader):
    """Union of the inputs that exist; a missing path is skipped, other errors are raised."""
    found = []
    for path in paths:
        try:
            found.append(reader(path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        raise FileNotFoundError(f"none of the inputs exists: {list(paths)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def union_tagged(parts):
    """Union of (tier, order, frame) with the tag columns; absent columns become NULL."""
    tagged = [df.withColumn("tier", F.lit(tier)).withColumn("ord", F.lit(order)) for tier, order, df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def write_json_lines(df, path):
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


DOCUMENT_ROWS = 10_000


def write_json_documents(df, path, rows_each=DOCUMENT_ROWS):
    """JSON array documents of at most that many rows, one a line; no row lost."""
    number = F.monotonically_increasing_id()
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"), number.alias("at"))
    # rows of one task are numbered through, from a multiple of 2^33
    part = rows.groupBy(F.shiftright("at", 33).alias("task"), F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / rows_each).alias("chunk"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))), lambda x: x["row"]), ",")
    part.agg(F.concat(F.lit("["), body, F.lit("]")).alias("value")).select("value").write.mode("errorifexists").text(path)


def case_truth(cases):
    """What credit.case_facts needs, from records of CASE_SCHEMA."""
    return cases.select("id", "fixed_query", "error_location", "error_type", F.col("performance_issue.type").alias("issue_type"))


def scenario_truth(scenarios):
    """What grading.scenario_facts needs, from records of SCENARIO_SCHEMA."""
    none = lambda kind: F.array().cast(kind)
    return scenarios.select(
        "id", F.coalesce(F.transform("tables", lambda t: F.struct(t["name"].alias("name"), t["rows"].alias("rows"))), none("array<struct<name:string,rows:bigint>>")).alias("tables"),
        F.coalesce(F.transform("slow_queries", lambda q: q["id"]), none("array<string>")).alias("queries"),
        F.coalesce(F.transform("missing_index_hints", lambda h: F.struct(h["table"].alias("table"), h["columns"].alias("columns"))),
                   none("array<struct<table:string,columns:array<string>>>")).alias("hints"))


def scenario_children(scenarios):
    """Flatten nested scenarios into tables, queries, hints and plan steps."""
    tier = F.split_part("id", F.lit("_"), F.lit(1)).alias("tier")
    return {
        "tables": scenarios.select("id", tier, F.posexplode("tables").alias("pos", "t")).select("id", "tier", "pos", "t.*"),
        "queries": scenarios.select(F.col("id").alias("scenario_id"), F.posexplode("slow_queries").alias("pos", "q"))
        .select("scenario_id", "pos", "q.*"),
        "hints": scenarios.select("id", F.posexplode("missing_index_hints").alias("pos", "h")).select("id", "pos", "h.*"),
        "plan": scenarios.select("id", F.posexplode("optimal_actions").alias("pos", "step")),
    }


# --------------------------------------------------------------- run logs

def two_digits(amount):
    return F.format_string("%.2f", F.round(amount, 2).cast("double"))


def step_line(step, action, reward, done):
    return F.format_string("[STEP] step=%d action=%s reward=%s done=%s error=null",
                           step, action, two_digits(reward), done.cast("string"))


def write_run_log(lines, path):
    """Lines prefixed by their run id, in run order inside each file."""
    (lines.repartition("episode_id").sortWithinPartitions("episode_id", "line_no")
     .select(F.concat_ws("\t", F.col("episode_id"), F.col("line")).alias("value"))
     .write.mode("errorifexists").text(path))


STEP_PATTERN = r"\[STEP\] step=(\d+) action=(\S+) reward=(-?[\d.]+) done=(true|false) error=(.*)"


def read_run_log(spark, path):
    """Step table from run-log lines; other lines and damaged lines are skipped."""
    raw = spark.read.text(path).select(F.split_part("value", F.lit("\t"), F.lit(1)).alias("run"),
                                       F.split_part("value", F.lit("\t"), F.lit(2)).alias("line"))

    def part(i):
        return F.regexp_extract("line", STEP_PATTERN, i)
    return raw.where(F.regexp_like("line", F.lit(f"^{STEP_PATTERN}$")) & F.regexp_like("run", F.lit(r"^-?\d+$"))).select(
        F.col("run").try_cast("bigint").alias("episode_id"), part(1).cast("bigint").alias("step_no"),
        part(2).alias("action_type"), part(3).cast("double").alias("reward"),
        (part(4) == "true").alias("done"))
