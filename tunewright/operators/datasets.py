"""Round trips through the dataset formats."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunewright.operators import ledger
from tunewright.session import shared_dir, table
from tunewright.sources import datasets as ds
from tunewright.sources.run_log import SCHEMA, RunLogSource
from tunewright.streaming.episodes import drain

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def json_array(spark, sf_dir):
    """Write the parts as JSON array documents and read them back."""
    path = shared_dir(spark, "json-array")
    ds.write_json_documents(table(spark, sf_dir, "part"), path)
    return ds.read_json_lines(spark, path, PART)


def whole_file_array(spark, sf_dir):
    """The multi-line reader on array documents, one per file and region."""
    path = shared_dir(spark, "json-file")
    nations = table(spark, sf_dir, "nation")
    per = nations.groupBy("n_regionkey").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))).alias("value"))
    per.repartition("n_regionkey").write.partitionBy("n_regionkey").text(path)
    rows = ds.read_json_array(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    return rows.join(c, rows.n_nationkey == c.c_nationkey, "left").select("n_nationkey", "n_name", "n_regionkey", "customers")


def tagged_union(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                            F.col("p_brand").alias("brand"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                F.col("s_acctbal").alias("balance"))
    return ds.union_tagged([("easy", 1, p), ("hard", 2, s)])


def tolerant(spark, sf_dir):
    paths = [f"{sf_dir}/{n}.parquet" for n in ("orders", "absent_table", "orders_old")]
    return ds.read_existing(paths, spark.read.parquet).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def flattened(spark, sf_dir):
    """Nested arrays to rows: per position of the vectors, count and sum."""
    rows = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding").alias("pos", "x"))
    value = F.col("x").cast("double").cast("decimal(18,8)")
    return rows.groupBy("pos").agg(F.count(F.lit(1)).alias("n"), F.sum(value).cast("double").alias("total"))


def json_lines(spark, sf_dir):
    path = shared_dir(spark, "json-lines")
    ds.write_json_lines(table(spark, sf_dir, "conversations"), path)
    back = ds.read_json_lines(spark, path, "conv_id bigint, turn bigint, role string, text string")
    return back.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"))


def training_log(spark, sf_dir):
    """Log rows that carry the metric; rows without it are dropped."""
    path = shared_dir(spark, "training-log")
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    ds.write_json_lines(rows.select(F.col("doc_id").alias("step"), F.col("quality").alias("loss")), path)
    return ds.read_json_lines(spark, path, "step bigint, loss double").where("loss IS NOT NULL")


def log_lines(spark, sf_dir):
    """[START], [STEP] and [END] lines per episode: one ledger, one to three lines per live step."""
    whole = ledger.in_episode().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = ledger.live(ledger.steps_of(spark, sf_dir)).select(
        "episode_id", "ts", "event_id", "step_no", "action_type", "reward", "done",
        F.max("step_no").over(whole).alias("n"), F.sum("reward").over(whole).alias("s"))
    last = F.col("step_no") == F.col("n")
    so_far = F.collect_list("reward").over(ledger.in_episode().rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("rs", F.when(last, so_far))
    score = F.greatest(F.lit(0).cast("decimal(18,4)"), F.least(F.lit(1).cast("decimal(18,4)"), F.round(F.col("s") / 10, 4)))

    def line(number, text):
        return F.struct(number.cast("bigint").alias("line_no"), text.alias("line"))
    start = F.format_string("[START] task=%d env=tunewright model=replay", F.col("episode_id"))
    step = ds.step_line(F.col("step_no"), F.col("action_type"), F.col("reward"), F.col("done"))
    end = F.format_string("[END] success=%s steps=%d score=%s rewards=%s", (score >= 0.5).cast("string"), F.col("n"),
                          F.format_string("%.3f", F.round(score, 3).cast("double")),
                          F.array_join(F.transform("rs", ds.two_digits), ","))
    lines = F.array(F.when(F.col("step_no") == 1, line(F.lit(0), start)), line(F.col("step_no"), step),
                    F.when(last, line(F.col("n") + 1, end)))
    return rows.select("episode_id", F.inline(F.filter(lines, lambda x: x.isNotNull())))


def parsed_log(spark, sf_dir):
    path = shared_dir(spark, "run-log")
    ds.write_run_log(log_lines(spark, sf_dir), path)
    return ds.read_run_log(spark, path)


def logged(spark, sf_dir):
    """Folder of the run log, written by the data source."""
    spark.dataSource.register(RunLogSource)
    path = shared_dir(spark, "run-log-source")
    ordered = log_lines(spark, sf_dir).repartition("episode_id").sortWithinPartitions("episode_id", "line_no")
    ordered.write.format("run_log").mode("append").save(path)
    return path


def log_source(spark, sf_dir):
    """The steps as the data source writes and reads them."""
    path = logged(spark, sf_dir)
    return spark.read.format("run_log").load(path)


def log_stream(spark, sf_dir):
    """The steps as a stream over the data source finds them."""
    path, out = logged(spark, sf_dir), shared_dir(spark, "run-log-steps")
    drain(spark.readStream.format("run_log").load(path), out, shared_dir(spark, "run-log-state"))
    return spark.read.schema(SCHEMA).parquet(out)


QUERIES = {
    "IO9_run_log_source": log_source,
    "IO9_run_log_stream": log_stream,
    "IO1_json_array": whole_file_array,
    "IO2_tagged_union": tagged_union,
    "IO3_tolerant_read": tolerant,
    "IO4_flatten": flattened,
    "IO5_json_lines": json_lines,
    "IO6_json_documents": json_array,
    "IO7_training_log": training_log,
    "IO8_run_log": log_lines,
    "IO9_parsed_run_log": parsed_log,
}
