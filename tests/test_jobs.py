"""Layout plans, dataset formats, extraction, leaks, percentiles, registry."""

import json
import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle.collect import oracles
from tunewright import dims, kernels
from tunewright.operators import corpus, layout, metrics, preparation, synthesis, validation, workload
from tunewright.plans import registry
from tunewright.session import shared_dir, table
from tunewright.sources import datasets as ds


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_has_no_exchange(spark, sf):
    assert "Exchange" not in plan(layout.bucketed_join(spark, sf))


def test_bucketed_pair_with_hot_key(spark, as_rows):
    fact = spark.range(9000).selectExpr("id AS fid", "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 700 END AS k")
    dim = spark.range(700).selectExpr("id AS dk", "id * 2 AS v")
    names = (layout.copy_name("f"), layout.copy_name("d"))
    layout.bucketed_pair(fact, dim, "k", "dk", "fid", names, (shared_dir(spark, "b"), shared_dir(spark, "b")))
    f, d = spark.table(names[0]), spark.table(names[1])
    assert f.where("k = 5").select("salt").distinct().count() == 16
    got = f.join(d.hint("merge"), (f.k == d.dk) & (f.salt == d.salt)).select("fid", "v")
    assert as_rows(got) == as_rows(fact.join(dim, fact.k == dim.dk).select("fid", "v"))
    assert "Exchange" not in plan(got)
    for n in names:
        layout.drop_copy(spark, n)
    with pytest.raises(ValueError):
        layout.drop_copy(spark, "PRIMARY")


def test_list_partition_is_pruned(spark, sf):
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan(layout.list_partitions(spark, sf))


def test_clustered_copy_pushes_filter(spark, sf):
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,42)]" in plan(layout.clustered(spark, sf))


def test_statistics_reach_the_catalogue(spark, sf):
    name = layout.copy_name("stats")
    table(spark, sf, "part").write.option("path", shared_dir(spark, "stats")).saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    facts = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} p_partkey").collect()}
    assert int(facts["distinct_count"]) > 0 and facts["num_nulls"] == "0"
    layout.drop_copy(spark, name)


def test_approximate_statistics_are_close(spark, sf):
    assert {r.column_name: r.few_values for r in layout.approximate_statistics(spark, sf).collect()} == {
        "o_orderkey": False, "o_custkey": False, "o_orderstatus": True, "o_orderpriority": True}
    orders = table(spark, sf, "orders")
    exact = {r.column_name: r.distinct_values for r in layout.statistics(spark, sf).collect()}
    for r in layout.approximate_profile(orders, layout.ORDER_COLUMNS).collect():
        assert abs(r.distinct_values - exact[r.column_name]) <= 0.1 * exact[r.column_name]


def test_approximate_counts_are_held_against_exact_ones(spark, monkeypatch, tmp_path):
    rows = spark.range(3000).selectExpr("id AS o_orderkey", "IF(id % 4 = 0, NULL, id % 500) AS o_custkey", "CAST(NULL AS STRING) AS o_orderstatus", "concat('p', id % 5) AS o_orderpriority")
    rows.write.parquet(f"{tmp_path}/some/orders.parquet")
    rows.where("false").write.parquet(f"{tmp_path}/none/orders.parquet")
    judged = lambda name: {r.column_name: (r.nulls, r.within_a_tenth) for r in layout.approximate_statistics(spark, f"{tmp_path}/{name}").collect()}
    assert judged("some") == {"o_orderkey": (0, True), "o_custkey": (750, True), "o_orderstatus": (3000, True), "o_orderpriority": (0, True)}
    assert judged("none") == dict.fromkeys(layout.ORDER_COLUMNS, (0, True))
    near = layout.approximate_profile
    monkeypatch.setattr(layout, "approximate_profile", lambda df, columns: near(df, columns).withColumn("distinct_values", F.col("distinct_values") * 2))
    assert {k: v for k, (_, v) in judged("some").items()} == {"o_orderkey": False, "o_custkey": False, "o_orderstatus": True, "o_orderpriority": False}


def test_date_range_is_pushed(spark, sf):
    assert "GreaterThanOrEqual(o_orderdate" in plan(corpus.date_range(spark, sf))


def test_top_three_is_trimmed_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(corpus.top_three(spark, sf))


def test_narrow_reads(spark, sf):
    text = plan(corpus.narrow_projection(spark, sf))
    assert "o_orderpriority" not in text and "c_mktsegment" not in text


def test_missing_inputs(spark, sf):
    with pytest.raises(FileNotFoundError):
        ds.read_existing([f"{sf}/none.parquet"], spark.read.parquet)


def test_json_documents_round_trip(spark, as_rows):
    df = spark.range(25_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS t")
    path = shared_dir(spark, "docs")
    ds.write_json_documents(df, path)
    assert as_rows(ds.read_json_lines(spark, path, "id bigint, t string").select("id")) == as_rows(df.select("id"))


def test_scenario_reader_and_children(spark, tmp_path):
    doc = [{"id": "easy_s1", "tables": [{"name": "t", "rows": 5, "indexes": ["PRIMARY"], "size_mb": 1}],
            "slow_queries": [{"id": "q1", "sql": "SELECT 1", "avg_ms": 5, "main_table": "t", "rows_examined": 5}],
            "missing_index_hints": [], "optimal_actions": ["inspect_query:q1", "submit_report"]}]
    (tmp_path / "s.json").write_text(json.dumps(doc))
    kids = ds.scenario_children(ds.read_json_array(spark, str(tmp_path / "s.json"), ds.SCENARIO_SCHEMA))
    assert {k: v.count() for k, v in kids.items()} == {"tables": 1, "queries": 1, "hints": 0, "plan": 2}
    case = [{"id": "c", "expected_output": [{"a": 1}], "database_schema": {"t": ["a INT"]}}, {"id": "d", "expected_output": "same"}]
    (tmp_path / "c.json").write_text(json.dumps(case))
    got = ds.read_json_array(spark, str(tmp_path / "c.json"), ds.CASE_SCHEMA).orderBy("id").collect()
    assert json.loads(got[0].expected_output) == [{"a": 1}] and got[1].expected_output == "same"


def test_observations_hide_answers(spark, tmp_path):
    case = [{"id": "easy_1", "description": "d", "buggy_query": "b", "fixed_query": "SECRET", "error_type": "syntax", "category": "syntax",
             "expected_output": [{"a": 1}, {"a": 2}], "performance_issue": {"type": "t", "impact": "i", "execution_time_fixed_ms": 5},
             "fix_description": "SECRET", "error_location": "SECRET"},
            {"id": "easy_2", "description": "d", "expected_output": "same rows", "fixed_query": "SECRET"}]
    (tmp_path / "c.json").write_text(json.dumps(case))
    cases = ds.read_json_array(spark, str(tmp_path / "c.json"), ds.CASE_SCHEMA)
    seen = validation.visible_cases(cases).orderBy("id")
    first, second = [r.asDict(True) for r in seen.collect()]
    assert first["performance_issue"] == {"type": "t", "impact": "i"} and json.loads(first["expected_output_sample"]) == {"a": 1}
    assert second["expected_output_sample"] is None and second["performance_issue"] is None and second["estimated_steps"] == 5
    assert "SECRET" not in str(first) + str(second)
    hint = cases.where("id = 'easy_1'").select(validation.case_hint(
        F.lit(9), F.col("error_location"), F.col("error_type"), F.col("category"), F.col("fix_description")).alias("h")).first().h
    assert hint == "Hint 3: Fix: SECRET"
    (tmp_path / "s.json").write_text(json.dumps([{"id": "hard_s1", "description": "x", "tables": [], "slow_queries": [],
                                                  "optimal_actions": ["SECRET"], "missing_index_hints": []}]))
    scenarios = ds.read_json_array(spark, str(tmp_path / "s.json"), ds.SCENARIO_SCHEMA)
    assert "SECRET" not in str(validation.visible_scenarios(scenarios).collect())
    assert [(r.id, r.tier) for r in validation.task_list(scenarios, cases).orderBy("id").collect()] == [
        ("easy_1", "easy"), ("easy_2", "easy"), ("hard_s1", "hard")]


def test_golden_output_compare(spark):
    actual = spark.createDataFrame([(1, "Alice", 3), (3, "Carol", 1)], "id int, name string, n int")
    golden = spark.createDataFrame([('{"id":1,"name":"Alice","n":3}',), ('{"id":2,"name":"Bob","n":0}',),
                                    ('{"id":3,"name":"Carol","n":1}',)], "expected string")
    got = corpus.golden_compare(actual, golden, "struct<id:int,name:string,n:int>").collect()
    assert [(r.id, r.side, r.copies) for r in got] == [(2, "missing", 1)]


@pytest.mark.parametrize("text,kind", [
    ('{"action_type": "a"}', "a"), ('```json\n{"action_type": "a"}\n```', "a"),
    ('see {x} {"k": {"action_type": "b"}} end', "b"), ('{"action_type": "c", "p": "}"} tail', "c"),
    ('{"k": 1} no action', None), ("", None), (None, None), ('[{"action_type": "d"}]', "d"),
])
def test_action_extraction(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string")
    assert preparation.extract_action(df, F.col("t")).first().action_type == kind


def test_columns_as_list_or_text(spark):
    df = spark.createDataFrame([('{"action_type":"x","payload":{"columns":"a, b"}}',),
                                ('{"action_type":"x","payload":{"columns":["a","b"]}}',)], "action_json string")
    assert [r.cols for r in preparation.with_payload(df).collect()] == [["a", "b"], ["a", "b"]]


def test_leaks_against_brute_force(spark, as_rows):
    texts = ["one two three four five six seven", "xone two three four five sixy", "alpha  beta gamma", "", "a b",
             "the quick brown fox jumps over the lazy dog again", "one two three four five six"] * 3
    secrets = ["one two three four five six", "ne two three four five si", "beta", "quick brown fox jumps over the lazy",
               "beta gamma", "a", "ab", "", "not there at all in any of them"]
    t = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    s = spark.createDataFrame(list(enumerate(secrets)), "item bigint, secret string")
    want = sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(secrets) if y and y in x)
    assert as_rows(validation.leaks(t, s)) == want
    long_only = s.where("item in (0, 3, 8)")
    assert as_rows(validation.leaks(t, long_only)) == [(i, j) for i, j in want if j in (0, 3, 8)]


def test_many_short_passages(spark, as_rows):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 6)))
    texts = [" ".join(word() for _ in range(200)) for _ in range(12)]
    secrets = [f"{word()} {word()}" if k % 3 else word() + word() for k in range(20_000)]
    t = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    s = spark.createDataFrame(list(enumerate(secrets)), "item bigint, secret string")
    assert as_rows(validation.leaks(t, s)) == sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(secrets) if y in x)


def test_leak_check_has_no_all_pairs(spark, sf):
    texts = table(spark, sf, "documents").selectExpr("doc_id AS id", "text")
    secrets = table(spark, sf, "benchmark").selectExpr("item_id AS item", "text AS secret")
    text = plan(validation.leaks(texts, secrets))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_sizes_follow_the_data(spark, sf):
    rows = table(spark, sf, "lineitem")
    few, many = layout.pieces(rows), layout.pieces(rows, 20_000)
    assert few == 1 and many > 5
    path = shared_dir(spark, "sized")
    layout.clustered_copy(rows, path, ["l_suppkey"], files=layout.pieces(rows, 50_000), tie="l_orderkey")
    assert len(spark.read.parquet(path).inputFiles()) == layout.pieces(rows, 50_000) and spark.read.parquet(path).count() == rows.count()


def test_pieces_follow_the_size_in_memory(spark, tmp_path):
    """Rows that a file holds in a few bytes, and that a sort holds at full width."""
    rows = spark.range(20_000).selectExpr("id", "repeat('x', 500) AS s", "array(id, id) AS a", "named_struct('b', CAST(NULL AS STRING)) AS `odd.name`", "CAST(NULL AS STRING) AS t")
    rows.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert 20_000 * 500 < layout.row_bytes(df) < 20_000 * 700 and layout.row_bytes(df.where("false")) == 0
    assert layout.pieces(df) == layout.pieces(df.where("false")) == 1 and 10 <= layout.pieces(df, per_sort=1 << 20) <= 14
    layout.clustered_copy(df, f"{tmp_path}/copy", ["s"], files=layout.pieces(df, per_sort=1 << 20), tie="id")
    assert len(spark.read.parquet(f"{tmp_path}/copy").inputFiles()) >= 10 and spark.read.parquet(f"{tmp_path}/copy").count() == 20_000


def test_augmentation_sorts_nothing_and_spreads_its_seeds(spark, monkeypatch, tmp_path):
    spark.range(40).selectExpr("id AS c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    want = synthesis.augmented(spark, str(tmp_path))
    monkeypatch.setattr(synthesis, "SEEDS_PER_TASK", 10)
    got = synthesis.augmented(spark, str(tmp_path))
    assert len(got.inputFiles()) > len(want.inputFiles()) == len(dims.GENERATOR_TIERS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3


def test_no_copy_is_left_in_the_catalogue(spark, sf):
    before = {t.name for t in spark.catalog.listTables()}
    layout.bucketed_join(spark, sf).count()
    layout.dropped_copy(spark, sf).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_one_scan_and_reduced_roll_up(spark, sf):
    from tunewright.operators import datasets, grading

    assert plan(datasets.log_lines(spark, sf)).count("FileScan") == 1
    text = plan(grading.roll_up(spark, sf))
    assert text.index("Expand") < text.index("keys=[task_id")


def test_records_of_a_file_are_graded(spark, tmp_path):
    """Reader, adapter and grader in a row: from JSON files of tasks to grades."""
    from tunewright.functions import credit
    from tunewright.operators import grading

    (tmp_path / "c.json").write_text(json.dumps([{"id": "easy_900", "fixed_query": "SELECT a FROM t", "error_type": "syntax", "error_location": "SELECT clause"},
                                                 {"id": "hard_901", "fixed_query": "SELECT b FROM t", "performance_issue": {"type": "N+1 query"}}]))
    (tmp_path / "s.json").write_text(json.dumps([{"id": "easy_s900", "tables": [{"name": "t", "rows": 200000}], "slow_queries": [{"id": "q1"}],
                                                  "missing_index_hints": [{"table": "t", "columns": ["a", "b"]}]}, {"id": "easy_s901"}]))
    cases = credit.case_facts(ds.case_truth(ds.read_json_array(spark, str(tmp_path / "c.json"), ds.CASE_SCHEMA)))
    answer = {f: None for f in credit.ANSWER_FIELDS} | {"fixed_query": "select a from t", "error_type": "syntax", "error_location": "select clause"}
    frame = spark.createDataFrame([("easy_900", *answer.values()), ("easy_902", *answer.values())], ", ".join(["task_id string", *[f"{f} string" for f in answer]]))
    assert {r.task_id: r.grade for r in credit.with_case_grade(frame, cases).collect()} == {"easy_900": 0.75, "easy_902": 0.001}
    facts = grading.scenario_facts(ds.scenario_truth(ds.read_json_array(spark, str(tmp_path / "s.json"), ds.SCENARIO_SCHEMA)))
    rows = [("easy_s900", "create_index", "t", ["a", "b"]), ("easy_s900", "partition_table", "t", []), ("easy_s901", "create_index", "t", ["a"])]
    acts = spark.createDataFrame(rows, "task_id string, action_type string, table_name string, cols array<string>").selectExpr(
        "*", *[f"CAST(NULL AS STRING) AS {c}" for c in ("query_id", "new_sql", "partition_column", "index_name", "column_name", "summary")])
    assert [r.grade for r in grading.with_action_grade(acts, facts).collect()] == [0.85, 0.65, 0.05]


def test_redaction_keeps_no_answer(spark, sf):
    got = validation.redacted(spark, sf)
    assert not {"quality", "toxic", "text"} & set(got.columns)
    assert got.where("issue LIKE '%quality%' OR issue LIKE '%toxic%'").count() == 0


def test_percentiles_against_sorting(spark):
    rows = [("a", i * 37 % 1009) for i in range(500)] + [("b", 7)] * 3 + [("c", 99_999)]
    df = spark.createDataFrame(rows, "template string, v int").selectExpr("template", "CAST(v AS DECIMAL(14,2)) AS exec_ms")
    hist = df.groupBy("template", "exec_ms").agg(F.count(F.lit(1)).alias("n"))
    got = {r.template: (float(r.p50_ms), float(r.p95_ms)) for r in workload.percentiles(hist, (50, 95), bin_ms=100).collect()}
    for name in "abc":
        values = sorted(v for t, v in rows if t == name)
        assert got[name] == tuple(float(values[(len(values) * p + 99) // 100 - 1]) for p in (50, 95))


def test_generator_rules(spark, sf):
    for tier, spec in dims.GENERATOR_TIERS.items():
        made = synthesis.scenarios(synthesis.seeds_of(spark, sf), "seed", tier)
        low, high = spec["rows"]
        bad = made.where(
            (F.size("tables") != spec["tables"]) | (F.size(F.array_distinct(F.transform("tables", lambda t: t["name"]))) != spec["tables"])
            | F.exists("tables", lambda t: (t["rows"] < low) | (t["rows"] > high) | (t["size_mb"] != F.floor(t["rows"] / 200)))
            | F.exists("slow_queries", lambda q: (q["avg_ms"] < 3000) | (q["avg_ms"] > 25000) | (q["columns"][0] == q["columns"][1]))
            | (F.size("missing_index_hints") != spec["queries"]))
        assert made.count() > 0 and bad.count() == 0
    ultra = synthesis.ultra(spark, sf)
    assert ultra.where("size(array_distinct(split(tables, ','))) <> n_tables OR avg_ms NOT BETWEEN 8000 AND 30000").count() == 0


def test_repair_of_every_mistake(spark):
    cases = [("SELECT id name FROM t", "syntax", "syntax error at name", "SELECT id, name FROM t"),
             ("SELECT * FROM t id = 1", "syntax", "", "SELECT * FROM t WHERE id = 1"),
             ("SELECT 'a", "syntax", "", "SELECT 'a'"),
             ("SELECT a FROM t ORDER a", "syntax", "", "SELECT a FROM t ORDER BY a"),
             ("SELECT a FROM t ORDER BY a", "syntax", "", "SELECT a FROM t ORDER BY a"),
             ("SELECT a FROM t group a", "syntax", "", "SELECT a FROM t GROUP BY a"),
             ("SELECT a FROM t INNER JOIN u", "logic", "", "SELECT a FROM t LEFT JOIN u"),
             ("SELECT a FROM t WHERE avg (x) > 1", "logic", "", "SELECT a FROM t HAVING avg(x) > 1"),
             ("SELECT * FROM t", "performance", "", "SELECT id, name, status, created_at FROM t")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "n int, q string, c string, m string, want string")
    got = df.select("n", preparation.repaired(F.col("q"), F.col("c"), F.col("m")).alias("r"), "want").collect()
    assert all(r.r == r.want for r in got), got


def test_relative_gain_without_base(spark, sf):
    assert metrics.averages(spark, sf).first().relative_gain is not None


def test_kernels_travel_by_value(tmp_path):
    """An executor without this package can run the kernels."""
    (tmp_path / "k.bin").write_bytes(cloudpickle.dumps(kernels.action_json))
    code = ("import pickle, sys; f = pickle.load(open('k.bin', 'rb')); "
            "print(list(f(['x {\"action_type\": 1}', None])), 'tunewright' in sys.modules)")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "['{\"action_type\": 1}', None] False", done.stderr


def test_every_query_is_named_once_and_has_an_oracle_or_a_reason():
    q, o = registry.queries(), oracles()
    assert len(q) > 150 and set(o) <= set(q) and set(q) <= set(entry.queries())
    assert set(q) - set(o) == {"L3_sketch_estimates", "L6_rewrite_costs"}  # estimates, and figures of a run


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("text,found", [
    ('{"a":' * 200_000, None), ('{' * 200_000, None), ('{"a":[1,{"b":' * 100 + '{"action_type": "x"}', '{"action_type": "x"}'),
    ('{"k": 1} {"action_type": "y", "n": {"action_type": "z"}}', '{"action_type": "y", "n": {"action_type": "z"}}'), ("", None)])
def test_search_survives_deep_and_broken_answers(text, found):
    assert kernels.action_json([text])[0] == found


ANSWERS = [
    ('Here is my answer:\n```json\n{"action_type": "optimize_query", "root_cause": "r"}\n```\n', "optimize_query", "SELECT 1", "r"),
    ('```{"fixed_query": "SELECT 7"}``` or ```{"fixed_query": "SELECT 8"}```', "submit_answer", "SELECT 7", None),
    ('{"fixed_query": "SELECT 9"}', "submit_answer", "SELECT 9", None), ("Here is ``` nothing", "identify_error", None, None)]


@pytest.mark.parametrize("answer,action,query,cause", ANSWERS)
def test_first_fence_of_an_answer_counts(spark, monkeypatch, tmp_path, answer, action, query, cause):
    spark.createDataFrame([(1, answer)], "event_id long, text string").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(preparation.views, "ANSWER", ["event_id", "text AS answer"])
    row = preparation.action_defaults(spark, str(tmp_path)).first()
    assert (row.action_type, row.query, row.root_cause) == (action, query, cause)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 100, 101, 4096, 4999])
def test_picks_are_a_permutation_of_every_round(spark, n):
    rows = spark.range(n * 2).select("id", F.floor(F.col("id") / n).alias("round"), synthesis.permuted(F.col("id") % n, F.lit(n).cast("bigint"), F.floor(F.col("id") / n) * 131 + 7).alias("x")).collect()
    first, second = ([r.x for r in rows if r["round"] == k] for k in (0, 1))
    assert sorted(first) == sorted(second) == list(range(n)) and (n < 16 or first != second and first != sorted(first))


def test_no_row_twice_in_a_round(spark, as_rows):
    pool = spark.createDataFrame([(k, "a" if k < 40 else "b") for k in range(57)], "id long, kind string")
    asked = spark.range(300).selectExpr("id AS event", "CASE WHEN id % 3 = 0 THEN 'b' ELSE 'a' END AS kind").selectExpr("event", "kind", "row_number() OVER (PARTITION BY kind ORDER BY event) - 1L AS nth")
    got = synthesis.round_picks(spark, pool, asked, "id", "kind")
    per = got.groupBy("kind", "round").agg(F.count("id").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert got.count() == 300 and all(r.n == r.d for r in per)
    assert {(r.kind, r["round"]): r.n for r in per}["a", 0] == 40 and {(r.kind, r["round"]): r.n for r in per}["b", 0] == 17


def test_frequent_words_pair_no_text_with_a_passage(spark, as_rows):
    """A passage whose longest word is in every text: only true matches come out, over several shards."""
    texts = [f"extraordinarily long texts number {k} go on" for k in range(300)] + ["an extraordinarily b c"]
    secrets = ["an extraordinarily b", "number 7 go", "extraordinarily", "texts number 299 go on", "go on"]
    t = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    s = spark.createDataFrame(list(enumerate(secrets)), "item bigint, secret string")
    want = sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(secrets) if y in x)
    assert as_rows(validation.leaks(t, s)) == want == as_rows(validation.leaks(t, s, shard_chars=20))


def _plain_search(text):
    at = text.find("{")
    while at >= 0:
        try:
            found, end = json.JSONDecoder().raw_decode(text, at)
            if "action_type" in found:
                return text[at:end]
        except json.JSONDecodeError:
            pass
        at = text.find("{", at + 1)
    return None


def test_search_is_that_of_a_decoder_at_every_brace():
    rng = random.Random(8)
    pieces = ['{"action_type": "x"', "{", "}", "[", "]", '"', ",", ":", '"a"', '"action_type"', " ", "1", "-0.5e3", "true", "nul", '"\\u0061ction_type"', '"\\"{"', '{"k": {', "\n", "it's {", '{"a": [1, {"action_type": 2}]}', "01"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(20_000)]
    got = kernels.action_json(texts)
    assert [g if isinstance(g, str) else None for g in got] == [_plain_search(t) for t in texts] and sum(isinstance(g, str) for g in got) > 500


def test_a_valid_action_after_deep_and_long_rubbish():
    action = '{"action_type": "create_index"}'
    for rubbish in ('{"a":' * 100_000, "{" * 500_000, '{"a": "' + "x" * 3_000_000 + '" ', '[{"b": ' * 50_000):
        assert kernels.action_json([rubbish + action])[0] == action
