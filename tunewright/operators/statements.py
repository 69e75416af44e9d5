"""What SQL statements refer to: tables, predicate columns and typical mistakes, as rows.

A statement is cut into tokens (strings, quoted names, comments, numbers, words,
signs) by one regular expression, and the tokens become rows.  Nesting is a running
count of parentheses; a window per depth gives every token the parenthesis it lies
in, a second one over the parentheses that hold a SELECT gives it its query, and the
last clause word of that query gives it its clause.  Everything after that is a
lookup among neighbours.  Callers hand in distinct statement templates, so the rows
are few however long the log is.

Names are folded to lower case; a column without a table belongs to the table of its
query, or of an enclosing one, that has such a column.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunewright.session import materialised

# accepted by Java and RE2
TOKEN = (r"(?:'[^']*')+" r'|(?:"[^"]*")+' r"|`[^`]*`|--[^\n]*|/\*(?s:.*?)\*/|[0-9]+(?:\.[0-9]+)?"
         r"|[A-Za-z_][A-Za-z0-9_$]*(?:\.(?:[A-Za-z_][A-Za-z0-9_$]*|\*))*|<=|>=|<>|!=|==|\|\||\S")
CLAUSES = ("SELECT", "FROM", "JOIN", "ON", "WHERE", "GROUP", "HAVING", "ORDER", "LIMIT", "UNION", "INTERSECT", "EXCEPT", "WINDOW")
RESERVED = CLAUSES + (
    "AS", "AND", "OR", "NOT", "IN", "IS", "NULL", "LIKE", "ILIKE", "BETWEEN", "EXISTS", "CASE", "WHEN", "THEN", "ELSE", "END", "BY", "ASC", "DESC",
    "DISTINCT", "ALL", "ANY", "SOME", "INNER", "LEFT", "RIGHT", "FULL", "OUTER", "CROSS", "SEMI", "ANTI", "NATURAL", "USING", "OVER", "PARTITION", "ROWS",
    "RANGE", "PRECEDING", "FOLLOWING", "UNBOUNDED", "CURRENT", "ROW", "WITH", "VALUES", "DATE", "TIMESTAMP", "INTERVAL", "TRUE", "FALSE", "OFFSET", "FETCH",
    "NULLS", "FIRST", "LAST", "ESCAPE", "FILTER")
COMPARISONS = ("=", "==", "<", ">", "<=", ">=", "<>", "!=", "LIKE", "ILIKE", "IN", "BETWEEN", "IS")
AGGREGATES = ("AVG", "SUM", "COUNT", "MAX", "MIN")


def tokens(statements: DataFrame) -> DataFrame:
    """One row per token of (template, sql): place i, text, word, nesting, query, clause, and the neighbours' words."""
    cut = F.filter(F.regexp_extract_all("sql", F.lit(TOKEN), F.lit(0)), lambda t: ~t.startswith("--") & ~t.startswith("/*"))
    rows = statements.select("template", F.posexplode(cut).alias("i", "text"))
    rows = rows.withColumn("word", F.upper("text"))
    line = Window.partitionBy("template").orderBy("i")
    upto, before = line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(Window.unboundedPreceding, -1)
    opens, closes = F.col("text") == "(", F.col("text") == ")"
    count = lambda c: F.sum(c.cast("int"))
    rows = rows.select("*", *[F.lead("word", k).over(line).alias(f"next{k}") for k in (1, 2, 3)], *[F.lag("word", k).over(line).alias(f"prev{k}") for k in (1, 2)],
                       F.lead("text", 1).over(line).alias("text1"), F.lead("text", 2).over(line).alias("text2"),
                       # both parentheses lie at the depth they enclose
                       (count(opens).over(upto) - F.coalesce(count(closes).over(before), F.lit(0))).alias("depth"))
    latest = Window.partitionBy("template", "depth").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("scope", F.coalesce(F.max(F.when(opens, F.col("i"))).over(latest), F.lit(-1)))
    within = Window.partitionBy("template", "scope")
    rows = rows.select("*", F.max(F.when(opens, F.col("next1").isin("SELECT", "WITH"))).over(within).alias("holds"),
                       F.max(F.when(opens, F.col("prev1"))).over(within).alias("caller"))
    holds = F.coalesce("holds", F.lit(False)) & (F.col("scope") >= 0)
    rows = rows.withColumn("level", count(opens & holds).over(upto) - F.coalesce(count(closes & holds).over(before), F.lit(0)))
    latest = Window.partitionBy("template", "level").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("query", F.coalesce(F.max(F.when(opens & holds, F.col("i"))).over(latest), F.lit(-1)))
    direct = F.col("scope") == F.col("query")
    clause = Window.partitionBy("template", "query").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", direct.alias("direct"),
                       F.last(F.when(direct & F.col("word").isin(*CLAUSES), F.col("word")), ignorenulls=True).over(clause).alias("clause"))
    name = F.col("text").rlike(r'^[A-Za-z_"`]') & ~F.col("word").isin(*RESERVED) & (F.coalesce("next1", F.lit("")) != "(") & ~F.col("text").endswith("*")
    return rows.select("*", name.alias("is_name"), F.lag("clause").over(line).alias("clause_before"))


def written_tokens(statements):
    """tokens, written once for the several lookups that follow."""
    return materialised(statements.sparkSession, tokens(statements), "tokens")


def plain_name(c):
    return F.lower(F.regexp_replace(c, '["`]', ""))


def is_word(c):
    return F.coalesce(c.rlike(r'^[A-Za-z_"`]') & ~F.upper(c).isin(*RESERVED), F.lit(False))


def references(rows: DataFrame) -> DataFrame:
    """(template, query, i, table_name, alias): the tables of every FROM clause."""
    at = F.col("clause").isin("FROM", "JOIN") & F.col("is_name") & F.col("direct") & F.col("prev1").isin("FROM", "JOIN", ",")
    alias = F.when((F.col("next1") == "AS") & is_word(F.col("text2")), F.col("text2")).when(is_word(F.col("text1")), F.col("text1"))
    last = F.element_at(F.split(plain_name(F.col("text")), r"\."), -1)
    return rows.where(at).select("template", "query", "i", last.alias("table_name"), F.coalesce(plain_name(alias), last).alias("alias"))


def spans(rows: DataFrame) -> DataFrame:
    """(template, query, first, final): where each query stands in its statement."""
    return rows.groupBy("template", "query").agg(F.min("i").alias("first"), F.max("i").alias("final"))


def comparisons(rows: DataFrame) -> DataFrame:
    """(template, query, i, clause, qualifier, column, op, kind): every column that is compared as it stands, in WHERE, ON or HAVING.

    `kind` is join where the other side is a column too.  A negated comparison has NOT
    before its operator, and a LIKE that starts with a wildcard is `LIKE %`; a column
    inside a function call is no predicate column.
    """
    name = F.col("is_name") & F.col("clause").isin("WHERE", "ON", "HAVING")
    negated = F.col("next1") == "NOT"
    op = F.when(negated, F.concat(F.lit("NOT "), F.col("next2"))).when(F.col("next1").isin(*COMPARISONS), F.col("next1"))
    op = F.when(~negated | F.col("next2").isin(*COMPARISONS), op)
    op = F.when(op.isin("LIKE", "ILIKE") & F.col("text2").rlike("^'[%_]"), F.concat(op, F.lit(" %"))).otherwise(op)
    other_word, after = F.when(negated, F.col("next3")).otherwise(F.col("next2")), F.when(negated, F.lit(None)).otherwise(F.col("next3"))
    other_is_name = is_word(other_word) & (F.coalesce(after, F.lit("")) != "(")
    left = rows.where(name & op.isNotNull()).select(
        "template", "query", "i", "clause", "text", op.alias("op"), F.when(other_is_name, "join").otherwise("filter").alias("kind"))
    # value = column: turned round
    signs = ("=", "==", "<", ">", "<=", ">=", "<>", "!=")
    turned = F.create_map(*[F.lit(x) for a, b in zip(signs, ("=", "==", ">", "<", ">=", "<=", "<>", "!=")) for x in (a, b)])
    ends = F.coalesce("next1", F.lit("AND")).isin("AND", "OR", ")", ";", *CLAUSES)
    before_is_name = is_word(F.col("prev2"))
    right = rows.where(name & F.col("prev1").isin(*signs) & ends).select(
        "template", "query", "i", "clause", "text", turned[F.col("prev1")].alias("op"), F.when(before_is_name, "join").otherwise("filter").alias("kind"))
    parts = F.split(plain_name(F.col("text")), r"\.")
    return left.unionByName(right).select(
        "template", "query", "i", "clause", F.when(F.size(parts) > 1, F.element_at(parts, -2)).alias("qualifier"), F.element_at(parts, -1).alias("column"),
        F.when(F.col("op") == "==", "=").when(F.col("op") == "!=", "<>").otherwise(F.col("op")).alias("op"), "kind")


def with_either(found: DataFrame, rows: DataFrame) -> DataFrame:
    """found with `either`: whether the comparison is one side of an OR, at whatever depth."""
    whole = rows.where(F.col("clause").isin("WHERE", "ON", "HAVING")).groupBy("template", "query", "clause", "scope").agg(
        F.min("i").alias("first"), F.max("i").alias("final"), F.max(F.col("word") == "OR").alias("has"))
    split = whole.where("has").select(F.col("template").alias("t"), F.col("query").alias("q"), F.col("clause").alias("c"), "first", "final")
    here = (F.col("template") == F.col("t")) & (F.col("query") == F.col("q")) & (F.col("clause") == F.col("c")) & (F.col("i") >= F.col("first")) & (F.col("i") <= F.col("final"))
    return found.join(split, here, "left").groupBy(*found.columns).agg(F.max(F.col("first").isNotNull()).alias("either"))


def resolved(found: DataFrame, refs: DataFrame, spans: DataFrame, columns: DataFrame) -> DataFrame:
    """found with `table_name`: the innermost enclosing query's table of that alias, or that has that column (columns: table_name, column)."""
    around = refs.join(spans, ["template", "query"]).select("template", F.col("query").alias("q"), "first", "final", "table_name", "alias")
    known = columns.select(F.col("table_name").alias("t"), F.col("column").alias("c"))
    has = around.join(known, around["table_name"] == known["t"], "left")
    inside = (F.col("i") >= F.col("first")) & (F.col("i") <= F.col("final"))
    by_alias = (F.col("qualifier") == F.col("alias")) & (F.col("c") == F.col("column"))
    by_column = F.col("qualifier").isNull() & (F.col("c") == F.col("column"))
    hit = found.join(has, (found["template"] == has["template"]) & inside & (by_alias | by_column)).select(found["*"], "q", "table_name")
    nearest = Window.partitionBy("template", "i").orderBy(F.desc("q"), "table_name")
    return hit.withColumn("r", F.row_number().over(nearest)).where("r = 1").drop("r", "q")


def predicates(statements: DataFrame, columns: DataFrame) -> DataFrame:
    """(template, table_name, column, op, kind, either) of statements (template, sql), each once; columns: (table_name, column) of the known tables."""
    rows = written_tokens(statements)
    found = with_either(comparisons(rows), rows)
    return resolved(found, references(rows), spans(rows), columns).select("template", "table_name", "column", "op", "kind", "either").distinct()


def tables_of(statements: DataFrame) -> DataFrame:
    """(template, query, table_name): the tables every query of a statement reads."""
    return references(tokens(statements)).select("template", "query", "table_name")


FLAGS = ("select_star", "function_on_column", "comma_join", "scalar_subquery", "aggregate_in_where", "window_without_order")


def mistakes(statements: DataFrame) -> DataFrame:
    """(template, flag): typical mistakes of each statement; what stands in strings and comments is no statement."""
    rows = written_tokens(statements)
    at = {
        "select_star": (F.col("clause") == "SELECT") & F.col("direct") & F.col("prev1").isin("SELECT", "DISTINCT", "ALL", ",") & ((F.col("text") == "*") | F.col("text").endswith(".*")),
        # a column among the arguments of a call, in a filter
        "function_on_column": (F.col("clause") == "WHERE") & F.col("is_name") & (F.col("scope") != F.col("query")) & is_word(F.col("caller")) & ~F.col("caller").isin(*AGGREGATES),
        "scalar_subquery": (F.col("text") == "(") & F.col("next1").isin("SELECT", "WITH") & (F.col("clause_before") == "SELECT"),
        "aggregate_in_where": (F.col("clause") == "WHERE") & F.col("word").isin(*AGGREGATES) & (F.col("next1") == "("),
        "window_without_order": (F.col("word") == "OVER") & (F.col("next1") == "(") & (F.col("next2") == ")"),
    }
    flag = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in at.items()])))
    plain = rows.select("template", flag.alias("flag")).distinct()
    # tables listed with commas whose query compares no two columns
    listed = rows.where((F.col("text") == ",") & (F.col("clause") == "FROM") & F.col("direct")).select("template", "query").distinct()
    tied = comparisons(rows).where("kind = 'join'").select("template", "query").distinct()
    loose = listed.join(tied, ["template", "query"], "left_anti").select("template").distinct()
    return plain.unionByName(loose.withColumn("flag", F.lit("comma_join")))
