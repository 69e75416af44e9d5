"""Z-ordered copies with a manifest, sketches per file, chosen layouts, plans that ran."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tunewright import dims
from tunewright.operators import layout, profiles, skipping, workload
from tunewright.session import materialised, shared_dir, table


# ---------------------------------------------------------------- Z order and skipping

def test_rank_is_the_number_of_borders_reached(spark):
    values = [2, 5, 5.5, 9]
    got = spark.createDataFrame([(x,) for x in (None, 1.0, 2.0, 4.9, 5.0, 6.0, 9.0, 99.0)], "x double").select(skipping.rank(F.col("x"), values)).collect()
    assert [r[0] for r in got] == [0, 0, 1, 1, 2, 3, 4, 4]


def test_z_order_interleaves_bits(spark):
    got = spark.createDataFrame([(0b101, 0b011)], "a long, b long").select(skipping.z_order([F.col("a"), F.col("b")], 3)).first()[0]
    assert got == 0b100111


@pytest.fixture(scope="module")
def boxed(spark, tmp_path_factory):
    """A copy of 20,000 rows on a date, a key with a hot value, and a text with nulls."""
    path = str(tmp_path_factory.mktemp("boxed") / "copy")
    rows = spark.range(20_000).selectExpr(
        "id", "date_add(DATE '2020-01-01', CAST(id * 7919 % 700 AS INT)) AS day", "CASE WHEN id % 3 = 0 THEN 7 ELSE id * 104729 % 5000 END AS k",
        "CASE WHEN id % 10 = 0 THEN NULL ELSE concat('t', id * 31 % 900) END AS s")
    skipping.z_ordered_copy(rows, path, ["day", "k", "s"], files=64, tie="id")
    return rows, path, materialised(spark, skipping.manifest(spark, path, ["day", "k", "s"]), "manifest")


@pytest.mark.parametrize("conditions, most", [
    ([("day", "=", "2020-05-05")], 0.5), ([("k", "=", 4321)], 0.45), ([("s", "=", "t77")], 0.6), ([("k", "IN", 11, 4999), ("day", "<", "2020-03-01")], 0.35),
    ([("k", "BETWEEN", 100, 120)], 0.6), ([("k", ">", 4990)], 0.6), ([("s", "IS NULL",)], 1.0), ([("k", "=", -5)], 0.0), ([("k", "=", 7)], 1.0), ([("s", ">=", "t9"), ("s", "<=", "t90")], 0.6)])
def test_few_files_and_all_matches(spark, as_rows, boxed, conditions, most):
    rows, path, files = boxed
    got, opened, there = skipping.read_matching(spark, path, files, conditions)
    want = rows
    for c in conditions:
        want = want.where(skipping.matches(*c))
    assert as_rows(got.select("id")) == as_rows(want.select("id"))
    assert opened <= most * there


def test_bitmaps_are_built_without_a_sort_of_rows(spark, boxed):
    """The bits that an aggregate of bitmaps sets, from hash tables of words alone."""
    rows, path, files = boxed
    numbers = skipping.manifest(spark, path, ["day", "k"])
    assert "SortAggregate" not in numbers._jdf.queryExecution().executedPlan().toString()
    want = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(*[
        F.bitmap_construct_agg(F.when(F.col(c).isNotNull(), skipping._bit(F.col(c), s))).alias(f"{c}_{s}") for c in ("day", "k", "s") for s in skipping.SEEDS])
    got = files.select("file", *[F.col(c)[f"map_{s}"].alias(f"{c}_{s}") for c in ("day", "k", "s") for s in skipping.SEEDS])
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 1


def test_hot_value_fills_no_file(spark, boxed):
    rows, path, files = boxed
    assert spark.read.parquet(path).count() == 20_000 and files.agg(F.max("rows")).first()[0] <= 3 * 20_000 / 64


def test_empty_table_and_one_row(spark, tmp_path):
    rows = spark.range(1).selectExpr("id AS a", "id AS b")
    for name, df in (("none", rows.where("false")), ("one", rows)):
        skipping.z_ordered_copy(df, f"{tmp_path}/{name}", ["a", "b"], files=8)
        files = skipping.manifest(spark, f"{tmp_path}/{name}", ["a", "b"])
        assert skipping.read_matching(spark, f"{tmp_path}/{name}", files, [("a", "=", 0)])[0].count() == df.count()


# ---------------------------------------------------------------- sketches

def test_refresh_reads_new_files_only(spark, tmp_path):
    path, columns = f"{tmp_path}/t", ["id", "g"]
    part = lambda k: spark.range(k * 10_000, (k + 1) * 10_000).selectExpr("id", "concat('g', id % 37) AS g")
    part(0).coalesce(2).write.parquet(path)
    profiles.refreshed(spark, path, columns).write.parquet(f"{tmp_path}/s0")
    first = set(spark.read.parquet(path).inputFiles())
    part(1).coalesce(2).write.mode("append").parquet(path)
    again = profiles.refreshed(spark, path, columns, f"{tmp_path}/s0")
    assert not first & {f for f in again.inputFiles() if "/t/" in f} and any("/t/" in f for f in again.inputFiles())
    again.write.parquet(f"{tmp_path}/s1")
    got = {r["column_name"]: r for r in profiles.merged(spark.read.parquet(f"{tmp_path}/s1")).collect()}
    assert got["id"]["row_count"] == 20_000 and (got["id"]["lo"], got["id"]["hi"]) == ("0", "19999") and got["id"]["files"] == 4
    assert abs(got["id"]["distinct_values"] / 20_000 - 1) < 0.03 and got["g"]["distinct_values"] == 37 and got["g"]["quantiles"] is None
    for q, value in zip(profiles.QUANTILES, got["id"]["quantiles"]):
        assert abs(value / 20_000 - q) < 0.02
    # nothing new: the stored rows as they are
    assert profiles.refreshed(spark, path, columns, f"{tmp_path}/s1").count() == 8


def test_estimates_are_near(spark, sf):
    got = {r["column_name"]: r["distinct_values"] for r in profiles.estimates(spark, sf).collect()}
    exact = table(spark, sf, "orders").agg(*[F.countDistinct(c).alias(c) for c in profiles.COLUMNS]).first()
    assert all(abs(got[c] / exact[c] - 1) < 0.05 for c in profiles.COLUMNS)


def test_statistics_change_the_plan(spark, sf):
    note = {}
    profiles.analysed_join(spark, sf, note)
    order = lambda text: [name for line in text.splitlines() for name in ("o_custkey", "c_custkey", "n_nationkey") if "Relation" in line and name in line]
    assert note["before"] != note["after"] and order(note["before"]) != order(note["after"])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tunewright_")]


# ---------------------------------------------------------------- chosen layouts

def test_greedy_against_every_set(spark):
    """Greedy picks serve what the best set of as many copies serves, or within 1 - 1/e of it."""
    rng = random.Random(5)
    sets, times = [], []
    for k in range(12):
        for t in rng.sample(("t", "u"), rng.randrange(1, 3)):
            cols = rng.sample("abcd", rng.randrange(1, 4))
            point = [c for c in cols if rng.random() < 0.6]
            sets.append((f"q{k}", t, cols, point, [c for c in cols if c not in point], [], 0))
        times.append((f"q{k}", float(rng.randrange(1, 100))))
    frame = spark.createDataFrame(sets, "template string, table_name string, cols array<string>, point array<string>, span array<string>, layouts array<string>, best int")
    t = spark.createDataFrame(times, "template string, ms double")
    ms, size = dict(times), {}
    for s in sets:
        size[s[0]] = size.get(s[0], 0) + len(s[2])

    def prefix(cols, point, span):
        n = 0
        for c in cols:
            if c in point:
                n += 1
            else:
                return n + (c in span)
        return n

    def served(chosen):
        return sum(max([prefix(c, s[3], s[4]) for n, c in chosen if n == s[1]] or [0]) * ms[s[0]] / size[s[0]] for s in sets)
    options = {(r["table_name"], tuple(r["cols"])) for r in workload.candidates(frame.join(t, "template")).collect()}
    got = workload.selected_layouts(spark, t, frame, copies=2).orderBy("pick").collect()
    mine = served([(r["layout_table"], r["layout_columns"].split(",")) for r in got])
    assert mine == pytest.approx(sum(r["gain_ms"] for r in got))
    best = max(served(pair) for pair in itertools.combinations([(n, list(c)) for n, c in options], 2))
    assert best * (1 - 1 / 2.718281828) <= mine <= best + 1e-9


def test_candidates_share_prefixes(spark):
    rows = [("q1", "t", ["a", "b"], ["a", "b"], [], 10.0), ("q2", "t", ["a"], ["a"], [], 90.0), ("q3", "t", ["a", "c"], ["a"], ["c"], 5.0)]
    frame = spark.createDataFrame(rows, "template string, table_name string, cols array<string>, point array<string>, span array<string>, ms double")
    got = {tuple(r["cols"]) for r in workload.candidates(frame).collect()}
    assert got == {("a",), ("a", "b"), ("a", "c")}


# ---------------------------------------------------------------- plans that ran

def test_figures_of_a_plan(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id % 7 AS g").repartition(3).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    row, figures = layout.plan_figures(t.groupBy("g").agg(F.count("id").alias("n")).agg(F.sum("n").alias("n")))
    assert row["n"] == 1000 and figures["rows_read"] == 1000 and figures["files"] == 3 and figures["exchanges"] == 2 and figures["joins"] == 0 and figures["bytes"] > 0
    _, twice = layout.plan_figures(t.join(t.select(F.col("id").alias("j")), F.col("id") == F.col("j") + 1).agg(F.count("id")))
    assert twice["joins"] == 1 and twice["rows_read"] == 2000


def test_rewrites_read_less(spark, sf):
    got = {(r["rewrite"], r["form"]): r for r in layout.rewrite_costs(spark, sf).collect()}
    assert len(got) == 6
    slow, fast = (got["subqueries_to_join", form] for form in ("slow", "fast"))
    assert slow["rows_read"] > fast["rows_read"] and slow["files"] > fast["files"] and slow["joins"] > fast["joins"]


def test_every_wanted_layout_is_in_the_prompt(spark, sf):
    from tunewright.operators import preparation
    prompts = [r["prompt"] for r in preparation.scenario_prompts(spark, sf).collect()]
    several = [cols for t, cols in dims.WANTED_LAYOUTS if t == "lineitem"]
    with_lineitem = [p for p in prompts if '"name":"lineitem"' in p]
    assert len(several) > 1 and with_lineitem and all(f'"columns":"{",".join(c)}"' in p for p in with_lineitem for c in several)
