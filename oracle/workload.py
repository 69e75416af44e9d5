"""Oracles of the workload operators."""

from oracle import macros as m
from tunewright import dims, views

def _fp(e):
    return f"regexp_replace(regexp_replace({e}, '''[^'']*''', '?', 'g'), '[0-9]+', '?', 'g')"


# What each statement of the log compares, told by hand: (event type, table, column, p point | r range | - of no use to an ordered copy).
FACTS = (
    ("view", "orders", "o_custkey", "p"), ("view", "orders", "o_orderstatus", "p"),
    ("click", "lineitem", "l_shipdate", "r"), ("click", "lineitem", "l_returnflag", "p"), ("click", "lineitem", "l_discount", "r"),
    ("signup", "customer", "c_nationkey", "p"), ("signup", "nation", "n_nationkey", "p"), ("signup", "customer", "c_custkey", "p"),
    ("purchase", "part", "p_type", "-"), ("purchase", "part", "p_size", "r"),
    ("error", "events", "user_id", "-"), ("error", "events", "event_type", "-"), ("error", "events", "ts", "r"),
)
# Mistakes of the statements of views.LINT, by event_id % 8, and of the log.
LINT_FACTS = ((0, "select_star"), (0, "function_on_column"), (1, "scalar_subquery"), (2, "comma_join"), (3, "aggregate_in_where"),
              (4, "window_without_order"), (5, "select_star"))
# Tables of the statements that read more than one.
LINT_JOINS = ((2, "part"), (2, "region"), (5, "orders"), (5, "customer"), (7, "orders"), (7, "customer"))


def _values(rows, head):
    return "(VALUES " + ", ".join("(" + ", ".join(m.lit(x) for x in row) + ")" for row in rows) + f") {head}"


_NAMED = [(name, "by_" + "_".join(cols) if k else "PRIMARY", cols) for name, layouts in dims.CATALOG for k, cols in enumerate(layouts)]
LAYOUTS = _values([(name, layout) for name, layout, _ in _NAMED], "lay(name, layout)")
LAYOUT_COLS = _values([(name, layout, k + 1, c) for name, layout, cols in _NAMED for k, c in enumerate(cols)], "lc(name, layout, k, col)")
_WANT = [(t, ",".join(cols), cols in dict(dims.CATALOG)[t]) for t, cols in dims.WANTED_LAYOUTS]
WANTED = _values(_WANT, "want(wt, wc, duplicate)")
WANTED_COLS = _values([(t, ",".join(cols), k + 1, c) for t, cols in dims.WANTED_LAYOUTS for k, c in enumerate(cols)], "lc(name, layout, k, col)")
COUNTS = "(" + " UNION ALL ".join(f"SELECT {m.lit(name)} AS name, count(*) AS row_count FROM {name}" for name, _ in dims.CATALOG) + ") tab"
PRED = ("list_slice(list_transform(list_filter(string_split(coalesce(string_split({0}, 'WHERE')[2], ''), 'AND'), lambda x: contains(x, '=')), "
        "lambda x: trim(string_split(x, '=')[1])), 1, 2)").format("template")


def _prefix(columns):
    """(et, name, layout, n): leading columns of each copy that a statement narrows by: points, and one range after them."""
    return f"""SELECT et, name, layout, CASE WHEN stop IS NULL THEN len ELSE stop - 1 + CAST(at_stop = 'r' AS INTEGER) END AS n FROM (
        SELECT e.et, lc.name, lc.layout, max(lc.k) AS len, min(lc.k) FILTER (coalesce(f.way, '-') <> 'p') AS stop,
          arg_min(coalesce(f.way, '-'), lc.k) FILTER (coalesce(f.way, '-') <> 'p') AS at_stop
        FROM (SELECT DISTINCT et, tn FROM facts) e JOIN {columns} ON lc.name = e.tn LEFT JOIN facts f ON f.et = e.et AND f.tn = lc.name AND f.col = lc.col
        GROUP BY 1, 2, 3)"""


BASE = f"""
WITH log AS (SELECT *, CASE WHEN main_table = 'events' THEN 'error' ELSE event_type END AS et FROM (
  {views.select(views.QUERY_LOG + ['event_type'], 'events')})),
t AS (SELECT {_fp('sql_text')} AS template, main_table, any_value(et) AS et, count(*) AS n, sum(exec_ms) AS ms,
        CAST(sum(exec_ms) AS DOUBLE) / count(*) AS avg_ms FROM log GROUP BY 1, 2),
facts AS (SELECT * FROM {_values(FACTS, 'f(et, tn, col, way)')}),
pre AS ({_prefix(LAYOUT_COLS)}),
best AS (SELECT et, name, max(n) AS n FROM pre GROUP BY 1, 2),
cov AS (SELECT t.*, (SELECT sum(n) FROM best WHERE best.et = t.et) / (SELECT count(*) FROM facts WHERE facts.et = t.et)::DOUBLE AS coverage FROM t)
"""

_LINT = f"""WITH l AS ({views.select(views.LINT + ['event_id % 8 AS kind'], 'events')}),
log AS ({views.select(views.QUERY_LOG, 'events')})"""
_ms = next(x for x in views.QUERY_LOG if x.endswith(" AS exec_ms"))
_text = next(x for x in views.LINT if x.endswith(" AS sql_text"))

# Copies that could serve the log's statements, told by hand, with the columns in the order of a search.
OPTIONS = (
    ("orders", ("o_custkey", "o_orderstatus")), ("orders", ("o_custkey",)), ("orders", ("o_orderstatus", "o_custkey")), ("orders", ("o_orderstatus",)),
    ("lineitem", ("l_returnflag", "l_shipdate")), ("lineitem", ("l_returnflag", "l_discount")), ("lineitem", ("l_returnflag",)),
    ("customer", ("c_custkey", "c_nationkey")), ("customer", ("c_nationkey", "c_custkey")), ("customer", ("c_custkey",)), ("customer", ("c_nationkey",)),
    ("nation", ("n_nationkey",)), ("part", ("p_size",)), ("events", ("ts",)),
)
OPTION_COLS = _values([(t, ",".join(cols), k + 1, c) for t, cols in OPTIONS for k, c in enumerate(cols)], "lc(name, layout, k, col)")


def _greedy(rounds):
    """Rounds of picking the copy that adds the most time; equal gains go to the copy with fewer columns."""
    out, have = [], "b0"
    for k in range(1, rounds + 1):
        out.append(f"""g{k} AS (SELECT w.name, w.layout, round(sum((w.n - h.n) * each), 6) AS gain FROM w JOIN {have} h USING (et, name) JOIN share USING (et) WHERE w.n > h.n GROUP BY 1, 2
            ORDER BY gain DESC, len(string_split(w.layout, ',')), w.name, w.layout LIMIT 1),
        b{k} AS (SELECT h.et, h.name, greatest(h.n, coalesce(w.n, 0)) AS n FROM {have} h LEFT JOIN (SELECT w.* FROM w JOIN g{k} USING (name, layout)) w ON w.et = h.et AND w.name = h.name)""")
        have = f"b{k}"
    return ", ".join(out)


ORACLE = {
    "W1_normalised_text": f"WITH log AS ({views.select(views.QUERY_LOG, 'events')}) SELECT query_id, {m.norm('sql_text')} AS normalised FROM log",
    "W2_fingerprints": f"{BASE} SELECT template, n, CAST(ms AS DOUBLE) AS total_ms FROM t",
    "W3_latency_profile": f"""{BASE}, r AS (SELECT {_fp('sql_text')} AS template, exec_ms,
            row_number() OVER (PARTITION BY {_fp('sql_text')} ORDER BY exec_ms) AS k,
            count(*) OVER (PARTITION BY {_fp('sql_text')}) AS c FROM log)
        SELECT template, count(*) AS executions, CAST(sum(exec_ms) AS DOUBLE) / count(*) AS avg_ms,
          CAST(max(CASE WHEN k = (c * 50 + 99) // 100 THEN exec_ms END) AS DOUBLE) AS p50_ms,
          CAST(max(CASE WHEN k = (c * 95 + 99) // 100 THEN exec_ms END) AS DOUBLE) AS p95_ms,
          CAST(max(exec_ms) AS DOUBLE) AS max_ms FROM r GROUP BY template""",
    "W4_slowest_templates": f"{BASE} SELECT template, main_table, avg_ms, n FROM t ORDER BY avg_ms DESC, template LIMIT 3",
    "W5_predicate_columns": f"{BASE} SELECT template, array_to_string({PRED}, ',') AS columns FROM t",
    "W6_layout_recommendations": f"""{BASE}, q AS (SELECT *, array_to_string({PRED}, ',') AS columns FROM t)
        SELECT main_table, columns, CAST(sum(n) AS BIGINT) AS executions, CAST(sum(ms) AS DOUBLE) AS total_ms,
          'Composite WHERE clause on ' || main_table AS reason FROM q WHERE columns <> '' GROUP BY main_table, columns""",
    "W6_layout_selection": f"""{BASE}, w AS ({_prefix(OPTION_COLS)}), b0 AS (SELECT * FROM best),
        share AS (SELECT t.et, CAST(t.ms AS DOUBLE) / (SELECT count(*) FROM facts WHERE facts.et = t.et) AS each FROM t), {_greedy(3)}
        """ + " UNION ALL ".join(f"SELECT {k} AS pick, name AS layout_table, layout AS layout_columns, CAST({m.amount4('gain')} AS DOUBLE) AS gain_ms FROM g{k}" for k in (1, 2, 3)),
    "W7_benefiting_queries": f"""{BASE} SELECT wt AS layout_table, wc AS layout_columns, template, n FROM t, {WANTED}
        WHERE contains(lower(template), wt) AND len(list_filter(string_split(wc, ','), lambda c: contains(lower(template), c))) > 0""",
    "W8_coverage": f"{BASE} SELECT template, n, CAST({m.r4('coverage')} AS DOUBLE) AS coverage FROM cov",
    "W9_time_shares": f"""{BASE} SELECT template, CAST({m.amount4('avg_ms')} AS DOUBLE) AS avg_ms, CAST(ms AS DOUBLE) AS total_ms,
        CAST({m.r4('CAST(ms AS DOUBLE) / (SELECT CAST(sum(ms) AS DOUBLE) FROM t)')} AS DOUBLE) AS time_share,
        CAST({m.amount4('CAST(ms AS DOUBLE) * (1.0::DOUBLE - coverage)')} AS DOUBLE) AS unserved_ms FROM cov""",
    "W9_workload_score": f"""{BASE} SELECT CAST({m.r4("sum(CAST(ms AS DOUBLE) * coverage) / CAST(sum(ms) AS DOUBLE)")} AS DOUBLE) AS served_share, count(*) AS templates FROM cov""",
    "W10_rewrite_gain": f"""WITH l AS (SELECT {_text}, {_ms}, event_id % 8 AS kind FROM events), f AS (SELECT * FROM {_values(LINT_FACTS, 'f(kind, flag)')}),
        per AS (SELECT flag, count(*) AS executions, sum(exec_ms) AS ms FROM l JOIN f USING (kind) GROUP BY 1), every AS (SELECT count(*) AS n, sum(exec_ms) AS ms FROM l)
        SELECT *, avg_ms - other_ms AS gain_ms FROM (SELECT flag, executions, CAST(per.ms AS DOUBLE) / executions AS avg_ms,
          CAST(every.ms - per.ms AS DOUBLE) / (n - executions) AS other_ms FROM per, every)""",
    "W11_what_if": f"""{BASE}, w AS ({_prefix(WANTED_COLS)}),
        b AS (SELECT w.name, w.layout, t.n, t.ms FROM w JOIN best USING (et, name) JOIN t USING (et) WHERE w.n > best.n)
        SELECT wt AS layout_table, wc AS layout_columns, duplicate, count(b.n) AS affected_templates, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS executions,
          CAST(coalesce(sum(b.ms), 0) AS DOUBLE) AS total_ms FROM {WANTED} LEFT JOIN b ON b.name = wt AND b.layout = wc GROUP BY 1, 2, 3""",
    "W12_scan_report": f"""{BASE}, used AS (SELECT DISTINCT et, pre.name, lc.col FROM pre JOIN {LAYOUT_COLS} ON lc.name = pre.name AND lc.layout = pre.layout AND lc.k <= pre.n),
        open AS (SELECT et, string_agg(tn || '.' || col, ',' ORDER BY tn || '.' || col) AS cols FROM facts WHERE (et, tn, col) NOT IN (SELECT et, name, col FROM used) GROUP BY 1)
        SELECT template, main_table, n, CAST(ms AS DOUBLE) AS total_ms, coverage > 0 AS served, coalesce(open.cols, '') AS unserved_columns FROM cov LEFT JOIN open USING (et)""",
    "W13_layout_report": f"""{BASE}, u AS (SELECT best.name, count(DISTINCT template) AS used_by, CAST(sum(t.n) AS BIGINT) AS executions FROM best JOIN t USING (et) WHERE best.n > 0 GROUP BY 1)
        SELECT tab.name, tab.row_count, (SELECT string_agg(layout, ',' ORDER BY layout <> 'PRIMARY', k) FROM (SELECT name, layout, row_number() OVER () AS k FROM {LAYOUTS}) WHERE name = tab.name) AS layouts,
          coalesce((SELECT string_agg(replace(wc, ',', '+'), ',' ORDER BY replace(wc, ',', '+')) FROM {WANTED} WHERE wt = tab.name AND NOT duplicate), '') AS missing,
          coalesce(used_by, 0) AS used_by, coalesce(executions, 0) AS executions FROM {COUNTS} LEFT JOIN u ON u.name = tab.name""",
    "W14_unused_layouts": f"""{BASE} SELECT name, layout FROM {LAYOUTS} WHERE layout <> 'PRIMARY' AND (name, layout) NOT IN (SELECT name, layout FROM pre WHERE n > 0)""",
    "W15_partition_candidates": "SELECT name, row_count, row_count > 100000 AS partition_candidate FROM (" + " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS row_count FROM {n}" for n in ("lineitem", "orders", "customer", "part", "events")) + ")",
    "W17_denormalisation": f"""{_LINT}, f AS (SELECT * FROM {_values(LINT_JOINS, 'f(kind, name)')})
        SELECT name, template, count(*) AS n FROM (SELECT name, {_fp('sql_text')} AS template FROM l JOIN f USING (kind)
          UNION ALL SELECT unnest(['customer', 'nation']), {_fp('sql_text')} FROM log WHERE main_table = 'customer') GROUP BY 1, 2""",
    "W18_lint_report": f"""{_LINT}, f AS (SELECT * FROM {_values(LINT_FACTS, 'f(kind, flag)')})
        SELECT flag, count(DISTINCT {_fp('sql_text')}) AS templates, count(*) AS executions FROM l JOIN f USING (kind) GROUP BY 1""",
}
