"""Query-log analytics: templates, latency profile, layout advice from measured time.

The log is reduced to statement templates first (a map-side aggregate), so every
text rule below runs once per template and not once per execution.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunewright import dims, views
from tunewright.functions.text import amount4, dbl, fingerprint, normalize, round4
from tunewright.operators import statements
from tunewright.session import materialised, table

# Comparisons that an ordered copy can look up, and those that end the lookup with a range.
POINT = ("=", "IN", "IS")
RANGE = ("<", ">", "<=", ">=", "BETWEEN", "LIKE")


def query_log(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*views.QUERY_LOG)


def histogram(log):
    """Executions per (template, latency), reduced map-side."""
    return (log.select(fingerprint(F.col("sql_text")).alias("template"), "main_table", "exec_ms")
            .groupBy("template", "main_table", "exec_ms").agg(F.count(F.lit(1)).alias("n")))


def templates(log):
    """One row per template with executions, total latency and one of its statements."""
    return (log.select(fingerprint(F.col("sql_text")).alias("template"), "main_table", "exec_ms", "sql_text")
            .groupBy("template", "main_table")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("exec_ms").alias("ms"), F.min("sql_text").alias("sql"))
            .withColumn("avg_ms", F.col("ms").cast("double") / F.col("n")))


def percentiles(hist, percents, bin_ms=1000):
    """Exact discrete percentiles per template from a (template, value, n) histogram.

    Bins locate the wanted ranks; only the bins that hold one are ordered by
    value.  A bin has at most 100 * bin_ms distinct values (two decimals).
    """
    hist = hist.withColumn("bin", F.floor(F.col("exec_ms") / bin_ms))
    bins = hist.groupBy("template", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("template")
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = bins.select("template", "bin", "n", F.sum("n").over(upto).alias("cum"),
                         F.sum("n").over(w).alias("total"))
    wanted = F.explode(F.array(*[F.lit(p) for p in percents])).alias("pct")
    rank = F.floor((F.col("total") * F.col("pct") + 99) / 100)
    places = (ranked.select("*", wanted).withColumn("rank", rank)
              .where((F.col("cum") >= F.col("rank")) & (F.col("cum") - F.col("n") < F.col("rank")))
              .select("template", "bin", "pct", (F.col("rank") - F.col("cum") + F.col("n")).alias("nth")))
    inside = Window.partitionBy("template", "pct").orderBy("exec_ms").rowsBetween(Window.unboundedPreceding, 0)
    values = (hist.groupBy("template", "bin", "exec_ms").agg(F.sum("n").alias("n"))
              .join(places, ["template", "bin"])
              .withColumn("seen", F.sum("n").over(inside)).where(F.col("seen") >= F.col("nth")))
    return values.groupBy("template").agg(*[
        F.min(F.when(F.col("pct") == p, F.col("exec_ms"))).alias(f"p{p}_ms") for p in percents])


def latency_profile(spark, sf_dir):
    # three reductions read the histogram: it is written once, so the log is scanned once
    hist = materialised(spark, histogram(query_log(spark, sf_dir)), "histogram")
    base = hist.groupBy("template").agg(
        F.sum("n").alias("executions"), F.sum(F.col("exec_ms") * F.col("n").cast("decimal(18,0)")).alias("ms"),
        F.max("exec_ms").alias("max_ms"))
    return base.join(percentiles(hist, (50, 95)), "template").select(
        "template", "executions", (F.col("ms").cast("double") / F.col("executions")).alias("avg_ms"),
        dbl(F.col("p50_ms"), "p50_ms"), dbl(F.col("p95_ms"), "p95_ms"), dbl(F.col("max_ms"), "max_ms"))


def normalised_text(spark, sf_dir):
    return query_log(spark, sf_dir).select("query_id", normalize(F.col("sql_text")).alias("normalised"))


def template_counts(spark, sf_dir):
    return templates(query_log(spark, sf_dir)).select("template", "n", dbl(F.col("ms"), "total_ms"))


def slowest(spark, sf_dir, k=3):
    return (templates(query_log(spark, sf_dir)).select("template", "main_table", "avg_ms", "n")
            .orderBy(F.desc("avg_ms"), "template").limit(k))


def predicate_columns(sql):
    """Left sides of the first two equality terms after WHERE."""
    tail = F.coalesce(F.try_element_at(F.split(sql, "WHERE"), F.lit(2)), F.lit(""))
    terms = F.filter(F.split(tail, "AND"), lambda t: F.contains(t, F.lit("=")))
    return F.slice(F.transform(terms, lambda t: F.trim(F.split_part(t, F.lit("="), F.lit(1)))), 1, 2)


def predicates(spark, sf_dir):
    t = templates(query_log(spark, sf_dir))
    return t.select("template", F.array_join(predicate_columns(F.col("template")), ",").alias("columns"))


def recommendations(spark, sf_dir):
    """Wanted layouts, merged over templates and ordered by the time they touch."""
    t = templates(query_log(spark, sf_dir))
    return (t.select("main_table", F.array_join(predicate_columns(F.col("template")), ",").alias("columns"), "n", "ms")
            .where("columns <> ''").groupBy("main_table", "columns")
            .agg(F.sum("n").alias("executions"), F.sum("ms").cast("double").alias("total_ms"))
            .withColumn("reason", F.concat(F.lit("Composite WHERE clause on "), F.col("main_table")))
            .orderBy(F.desc("total_ms"), "main_table", "columns"))


def layout_array(layouts):
    """Literal array<struct<table, cols>> of candidate layouts (a handful)."""
    return F.array(*[F.struct(F.lit(t).alias("table"), F.array(*[F.lit(c) for c in cols]).alias("cols"))
                     for t, cols in layouts])


def benefits(sql, layout):
    low = F.lower(sql)
    return F.contains(low, layout["table"]) & F.exists(layout["cols"], lambda c: F.contains(low, F.lower(c)))


def benefiting(spark, sf_dir):
    """Templates that mention the table and any column of a wanted layout."""
    t = templates(query_log(spark, sf_dir))
    hit = F.filter(layout_array(dims.WANTED_LAYOUTS), lambda x: benefits(F.col("template"), x))
    return (t.select("template", "n", F.explode(hit).alias("l"))
            .select(F.col("l.table").alias("layout_table"), F.array_join("l.cols", ",").alias("layout_columns"),
                    "template", "n"))


def layout_name(cols):
    return "by_" + "_".join(cols)


def copies_of(layouts):
    """Literal array<struct<layout, cols>>: the columns every copy of a table is ordered by; the first copy is the table itself."""
    return F.array(*[F.struct(F.lit(layout_name(cols) if k else "PRIMARY").alias("layout"), F.array(*map(F.lit, cols)).alias("cols"))
                     for k, cols in enumerate(layouts)])


def catalog_table(spark, sf_dir):
    """(name, row_count, layouts) with measured rows."""
    def one(name, layouts):
        return table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count", copies_of(layouts).alias("layouts"))
    return reduce(DataFrame.unionByName, [one(*entry) for entry in dims.CATALOG])


def known_columns(spark, sf_dir):
    """(table_name, column) as the files have them."""
    rows = [(name, column) for name, _ in dims.CATALOG for column in table(spark, sf_dir, name).columns]
    return dims.inline(spark, ("table_name", "column"), rows)


def looked_up(cols, point, span):
    """How many leading columns of an ordered copy narrow a search: point lookups, and one range at the end."""
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("open"))
    def step(state, c):
        exact, within = F.array_contains(point, c), F.array_contains(span, c)
        return F.struct((state["n"] + (state["open"] & (exact | within)).cast("int")).alias("n"), (state["open"] & exact).alias("open"))
    return F.aggregate(cols, start, step, lambda s: s["n"])


def predicate_sets(spark, sf_dir, t):
    """(template, table_name, cols, point, span, layouts) of templates (template, sql): what each compares, and the copies there are."""
    found = statements.predicates(t.select("template", "sql"), known_columns(spark, sf_dir))
    usable = ~F.col("either")
    sets = found.groupBy("template", "table_name").agg(
        F.array_sort(F.collect_set("column")).alias("cols"),
        F.collect_set(F.when(usable & F.col("op").isin(*POINT), F.col("column"))).alias("point"),
        F.collect_set(F.when(usable & F.col("op").isin(*RANGE), F.col("column"))).alias("span"))
    copies = F.create_map(*[x for name, layouts in dims.CATALOG for x in (F.lit(name), copies_of(layouts))])
    sets = sets.withColumn("layouts", copies[F.col("table_name")])
    return sets.withColumn("best", F.array_max(F.transform("layouts", lambda x: looked_up(x["cols"], F.col("point"), F.col("span")))))


def analysed(spark, sf_dir):
    """(templates of the log, their predicate sets); the templates are read twice, so the log is reduced once."""
    t = materialised(spark, templates(query_log(spark, sf_dir)), "templates")
    return t, predicate_sets(spark, sf_dir, t)


def covered_templates(spark, sf_dir):
    """Templates with the share of their predicate columns that the best copy of each table narrows the search by."""
    t, sets = analysed(spark, sf_dir)
    share = sets.groupBy("template").agg((F.sum("best") / F.sum(F.size("cols"))).alias("coverage"))
    return t.join(share, "template", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def coverage_scores(spark, sf_dir):
    return covered_templates(spark, sf_dir).select("template", "n", dbl(round4(F.col("coverage")), "coverage"))


def time_shares(spark, sf_dir):
    """Measured latency of each template, its share of all logged time, and the part no layout serves."""
    t = covered_templates(spark, sf_dir)
    total = t.agg(F.sum("ms")).scalar()
    return t.select("template", dbl(amount4(F.col("avg_ms")), "avg_ms"), dbl(F.col("ms"), "total_ms"),
                    dbl(round4(F.col("ms").cast("double") / total.cast("double")), "time_share"),
                    dbl(amount4(F.col("ms").cast("double") * (F.lit(1.0) - F.col("coverage"))), "unserved_ms"))


def workload_score(spark, sf_dir):
    """Share of the logged time that runs on predicates a layout serves."""
    t = covered_templates(spark, sf_dir)
    part = F.sum(F.col("ms").cast("double") * F.col("coverage"))
    return t.agg(dbl(round4(part / F.sum("ms").cast("double")), "served_share"), F.count(F.lit(1)).alias("templates"))


def flagged(spark, t):
    """(template, flag) of templates (template, sql)."""
    return statements.mistakes(t.select("template", "sql"))


def lint_templates(log):
    """(template, n, ms, sql) of statements (sql_text, exec_ms)."""
    return log.groupBy(fingerprint(F.col("sql_text")).alias("template")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("exec_ms").alias("ms"), F.min("sql_text").alias("sql"))


def rewrite_gains(spark, sf_dir):
    """Measured mean latency of statements with a mistake against those without it."""
    ms = next(x for x in views.QUERY_LOG if x.endswith(" AS exec_ms"))
    text = next(x for x in views.LINT if x.endswith(" AS sql_text"))
    t = materialised(spark, lint_templates(table(spark, sf_dir, "events").selectExpr(text, ms)), "lint")
    per = flagged(spark, t).join(t, "template").groupBy("flag").agg(F.sum("n").alias("executions"), F.sum("ms").alias("ms"))
    every = t.agg(F.sum("n").alias("all_n"), F.sum("ms").alias("all_ms"))
    mean = lambda ms, n: ms.cast("double") / n
    # one row beside a handful
    per = per.join(F.broadcast(every)).select(
        "flag", "executions", mean(F.col("ms"), F.col("executions")).alias("avg_ms"),
        mean(F.col("all_ms") - F.col("ms"), F.nullif(F.col("all_n") - F.col("executions"), F.lit(0))).alias("other_ms"))
    return per.select("*", (F.col("avg_ms") - F.col("other_ms")).alias("gain_ms"))


def wanted_table(spark):
    rows = [(t, ",".join(cols), cols, cols in dict(dims.CATALOG).get(t, ())) for t, cols in dims.WANTED_LAYOUTS]
    return dims.inline(spark, ("layout_table", "layout_columns", "cols", "duplicate"), rows)


def what_if(spark, sf_dir):
    """For each wanted layout the templates it serves better than what is there, and their logged time."""
    t, sets = analysed(spark, sf_dir)
    wanted = wanted_table(spark).withColumnRenamed("cols", "wanted_cols")
    both = wanted.join(sets, F.col("layout_table") == F.col("table_name"), "left").join(t.select("template", "n", "ms"), "template", "left")
    better = F.coalesce(looked_up(F.col("wanted_cols"), F.col("point"), F.col("span")) > F.col("best"), F.lit(False))
    return both.groupBy("layout_table", "layout_columns", "duplicate").agg(
        F.sum(better.cast("bigint")).alias("affected_templates"),
        F.sum(F.when(better, F.col("n")).otherwise(0)).alias("executions"),
        F.coalesce(F.sum(F.when(better, F.col("ms"))), F.lit(0)).cast("double").alias("total_ms"))


def candidates(sets, most_columns=3):
    """(table_name, cols): copies that could narrow some template's search: its point columns, and one range column after them; and their prefixes.

    Point columns stand in the order of the time that asks for them, so that copies
    for different templates share prefixes.
    """
    asked = sets.select("table_name", "ms", F.explode("point").alias("c")).groupBy("table_name", "c").agg(F.sum("ms").alias("w"))
    asked = asked.groupBy("table_name").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("o"), "c"))), lambda x: x["c"]).alias("order"))
    rows = sets.join(asked, "table_name", "left").withColumn("lead", F.filter(F.coalesce("order", F.array().cast("array<string>")), lambda c: F.array_contains("point", c)))
    ends = F.concat(F.array(F.array().cast("array<string>")), F.transform(F.array_except("span", "point"), lambda c: F.array(c)))
    full = rows.select("table_name", "lead", F.explode(ends).alias("end")).select("table_name", F.slice(F.concat("lead", "end"), 1, most_columns).alias("full"))
    prefixes = F.transform(F.sequence(F.lit(1), F.size("full")), lambda k: F.slice("full", 1, k))
    return full.where(F.size("full") > 0).select("table_name", F.explode(prefixes).alias("cols")).distinct()


def selected_layouts(spark, t, sets, copies=3):
    """Up to `copies` new copies, each the one that serves the most logged time beyond those before it.

    The time served is a monotone submodular function of the set of copies (a template
    counts with its best copy of each table), so picking greedily comes within 1 - 1/e
    of the best set.  One aggregate over (candidate, template) rows a round.
    """
    share = sets.groupBy("template").agg(F.sum(F.size("cols")).alias("all"))
    sets = sets.join(t.select("template", "ms"), "template").join(share, "template").withColumn("each", F.col("ms").cast("double") / F.col("all"))
    sets = materialised(spark, sets.drop("layouts"), "sets")
    options = candidates(sets).withColumnRenamed("cols", "layout")
    n = looked_up(F.col("layout"), F.col("point"), F.col("span"))
    gains = materialised(spark, sets.join(options, "table_name").select("template", "table_name", "each", "best", "layout", n.alias("n")).where("n > best"), "gains")
    chosen = []
    for pick in range(1, copies + 1):
        best = gains.groupBy("table_name", "layout").agg(F.sum((F.col("n") - F.col("best")) * F.col("each")).alias("gain_ms")).select(
            "table_name", "layout", F.round("gain_ms", 6).alias("gain_ms")).orderBy(F.desc("gain_ms"), F.size("layout"), "table_name", "layout").first()
        if best is None:
            break
        chosen.append((pick, best["table_name"], ",".join(best["layout"]), best["gain_ms"]))
        name, cols = best["table_name"], F.array(*map(F.lit, best["layout"]))
        # what a template has from here on: the better of its best and the pick
        now = sets.select("template", "table_name", F.greatest("best", F.when(F.col("table_name") == name, looked_up(cols, F.col("point"), F.col("span"))).otherwise(0)).alias("best"),
                          *[c for c in sets.columns if c not in ("template", "table_name", "best")])
        sets = materialised(spark, now, "sets")
        gains = materialised(spark, gains.drop("best").join(sets.select("template", "table_name", "best"), ["template", "table_name"]).where("n > best"), "gains")
    return spark.createDataFrame(chosen, "pick int, layout_table string, layout_columns string, gain_ms double")


def layout_selection(spark, sf_dir):
    """Three copies that together serve the most time beyond the copies there are, and the time each adds."""
    t, sets = analysed(spark, sf_dir)
    return selected_layouts(spark, t, materialised(spark, sets, "predicates")).withColumn("gain_ms", dbl(amount4(F.col("gain_ms")), "gain_ms"))


def scan_report(spark, sf_dir):
    """Templates with or without a layout behind their predicates, what they cost in the log, and the columns no layout narrows by."""
    t, sets = analysed(spark, sf_dir)
    used = F.flatten(F.transform("layouts", lambda x: F.slice(x["cols"], 1, looked_up(x["cols"], F.col("point"), F.col("span")))))
    bare = F.transform(F.array_except("cols", used), lambda c: F.concat(F.col("table_name"), F.lit("."), c))
    per = sets.groupBy("template").agg(F.max("best").alias("best"), F.array_join(F.array_sort(F.flatten(F.collect_list(bare))), ",").alias("bare"))
    return t.join(per, "template", "left").select(
        "template", "main_table", "n", dbl(F.col("ms"), "total_ms"), (F.coalesce("best", F.lit(0)) > 0).alias("served"), F.coalesce("bare", F.lit("")).alias("unserved_columns"))


def layout_report(spark, sf_dir):
    """Per table: its rows, layouts, use by templates, and wanted layouts that are missing."""
    t, sets = analysed(spark, sf_dir)
    used = (sets.where("best > 0").join(t.select("template", "n"), "template").groupBy(F.col("table_name").alias("used"))
            .agg(F.countDistinct("template").alias("used_by"), F.sum("n").alias("executions")))
    wanted = wanted_table(spark).where("NOT duplicate").groupBy(F.col("layout_table").alias("hinted")).agg(
        F.array_join(F.array_sort(F.collect_list(F.replace("layout_columns", F.lit(","), F.lit("+")))), ",").alias("missing"))
    base = catalog_table(spark, sf_dir).join(wanted, F.col("name") == F.col("hinted"), "left").join(used, F.col("name") == F.col("used"), "left")
    return base.select(
        "name", "row_count", F.array_join("layouts.layout", ",").alias("layouts"), F.coalesce("missing", F.lit("")).alias("missing"),
        F.coalesce("used_by", F.lit(0)).alias("used_by"), F.coalesce("executions", F.lit(0)).alias("executions"))


def unused_layouts(spark, sf_dir):
    """Layouts that narrow no template's search (the table's own order is never offered for removal)."""
    _, sets = analysed(spark, sf_dir)
    used = (sets.select("table_name", "point", "span", F.explode("layouts").alias("l"))
            .where(looked_up(F.col("l.cols"), F.col("point"), F.col("span")) > 0).select(F.col("table_name").alias("name"), "l.layout"))
    every = dims.inline(spark, ("name", "layout"), [(name, layout_name(c)) for name, layouts in dims.CATALOG for c in layouts[1:]])
    return every.join(used, ["name", "layout"], "left_anti")


def partition_candidates(spark, sf_dir, large=100_000):
    """Row counts of the real tables against the size from which partitioning pays."""
    names = ("lineitem", "orders", "customer", "part", "events")
    counts = [table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("row_count")).withColumn("name", F.lit(n)) for n in names]
    return (reduce(lambda a, b: a.unionByName(b), counts)
            .select("name", "row_count", (F.col("row_count") > large).alias("partition_candidate")))


def lint_log(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*views.LINT)


def denormalisation(spark, sf_dir):
    """Statements that read a table together with others: what a copied column could save."""
    log = lint_log(spark, sf_dir).select("sql_text").unionByName(query_log(spark, sf_dir).select("sql_text"))
    t = materialised(spark, lint_templates(log.withColumn("exec_ms", F.lit(0))), "lint")
    read = statements.tables_of(t)
    joined = read.groupBy("template", "query").agg(F.count(F.lit(1)).alias("k"), F.collect_set("table_name").alias("names")).where("k > 1")
    return joined.select("template", F.explode("names").alias("name")).distinct().join(t, "template").select("name", "template", "n")


def lint_report(spark, sf_dir):
    """How many templates and executions show each mistake."""
    log = (lint_log(spark, sf_dir).select("sql_text")
           .unionByName(query_log(spark, sf_dir).select("sql_text")))
    t = materialised(spark, lint_templates(log.withColumn("exec_ms", F.lit(0))), "lint")
    return flagged(spark, t).join(t, "template").groupBy("flag").agg(F.count(F.lit(1)).alias("templates"), F.sum("n").alias("executions"))


QUERIES = {
    "W1_normalised_text": normalised_text,
    "W2_fingerprints": template_counts,
    "W3_latency_profile": latency_profile,
    "W4_slowest_templates": slowest,
    "W5_predicate_columns": predicates,
    "W6_layout_recommendations": recommendations,
    "W6_layout_selection": layout_selection,
    "W7_benefiting_queries": benefiting,
    "W8_coverage": coverage_scores,
    "W9_time_shares": time_shares,
    "W9_workload_score": workload_score,
    "W10_rewrite_gain": rewrite_gains,
    "W11_what_if": what_if,
    "W12_scan_report": scan_report,
    "W13_layout_report": layout_report,
    "W14_unused_layouts": unused_layouts,
    "W15_partition_candidates": partition_candidates,
    "W17_denormalisation": denormalisation,
    "W18_lint_report": lint_report,
}
