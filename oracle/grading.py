"""Oracles of the graders."""

from oracle import ledger, macros as m
from tunewright import dims, views

V3 = """p AS (SELECT d.doc_id, d.text AS submitted, b.text AS expected FROM documents d
      LEFT JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))"""
SUBS = f"""WITH subs AS ({views.select(views.CASE_SUBMISSION, 'events')}), {m.graded('subs')}"""

TAB = "(VALUES " + ", ".join(f"({m.lit(s['id'])}, {m.lit(t[0])}, {t[1]})" for s in dims.SCENARIOS for t in s["tables"]) + ") st(sid, tname, trows)"
QRY = "(VALUES " + ", ".join(f"({m.lit(s['id'])}, {m.lit(q)})" for s in dims.SCENARIOS for q in s["queries"]) + ") sq(sid, qid)"
HINT = "(VALUES " + ", ".join(f"({m.lit(s['id'])}, {m.lit(h[0])}, {m.sql_list(h[1])})" for s in dims.SCENARIOS for h in s["hints"]) + ") sh(sid, htable, hcols)"
IDS = m.sql_list([s["id"] for s in dims.SCENARIOS])
_COLS = "list_filter(list_transform(string_split(coalesce(cols, ''), ','), lambda x: trim(x)), lambda x: x <> '')"


def actions_of(source):
    """Actions graded against their scenarios."""
    return f"""
acts AS (SELECT *, trim(coalesce(query_id, '')) AS q, trim(coalesce(table_name, '')) AS t, trim(coalesce(index_name, '')) AS i,
    lower(trim(coalesce(new_sql, ''))) AS s, {_COLS} AS cl, length(trim(coalesce(summary, ''))) AS n
  FROM ({source})),
looked AS (SELECT acts.*, EXISTS (SELECT 1 FROM {TAB} WHERE sid = task_id AND tname = t) AS tok,
    EXISTS (SELECT 1 FROM {TAB} WHERE sid = task_id AND tname = t AND trows > 100000) AS big,
    EXISTS (SELECT 1 FROM {QRY} WHERE sid = task_id AND qid = q) AS qok,
    coalesce((SELECT max(CAST(len(list_intersect(hcols, cl)) AS DOUBLE) / len(hcols)) FROM {HINT} WHERE sid = task_id AND htable = t), 0) AS best
  FROM acts),
agrades AS (SELECT event_id, task_id, action_type, CASE WHEN NOT list_contains({IDS}, task_id) THEN 0.10 ELSE {m.clamp('''CASE action_type
    WHEN 'inspect_query' THEN CASE WHEN qok THEN 0.40 WHEN q <> '' THEN 0.10 ELSE 0.05 END
    WHEN 'analyze_indexes' THEN CASE WHEN tok THEN 0.35 WHEN t <> '' THEN 0.08 ELSE 0.05 END
    WHEN 'create_index' THEN CASE WHEN NOT tok THEN 0.05 WHEN len(cl) = 0 THEN 0.10 WHEN best >= 1 THEN 0.85 WHEN best >= 0.5 THEN 0.55 ELSE 0.20 END
    WHEN 'rewrite_query' THEN least(0.65, CASE WHEN qok THEN 0.20 WHEN q <> '' THEN 0.05 ELSE 0.03 END
        + CASE WHEN length(s) > 15 THEN (CASE WHEN NOT contains(s, 'select *') THEN 0.10 ELSE 0 END)
            + (CASE WHEN contains(s, 'join') AND contains(s, 'where') THEN 0.10 ELSE 0 END)
            + (CASE WHEN contains(s, 'index') THEN 0.08 ELSE 0 END)
            + (CASE WHEN contains(s, 'left join') OR contains(s, 'inner join') THEN 0.05 ELSE 0 END) ELSE 0 END)
    WHEN 'partition_table' THEN CASE WHEN big AND trim(coalesce(partition_column, '')) <> '' THEN 0.75 WHEN big THEN 0.65 WHEN tok THEN 0.20 ELSE 0.05 END
    WHEN 'analyze_statistics' THEN CASE WHEN tok THEN 0.30 ELSE 0.08 END
    WHEN 'drop_index' THEN CASE WHEN tok AND i <> '' AND i <> 'PRIMARY' THEN 0.25 WHEN i = 'PRIMARY' THEN 0.001 ELSE 0.05 END
    WHEN 'add_column' THEN CASE WHEN tok AND trim(coalesce(column_name, '')) <> '' THEN 0.25 ELSE 0.05 END
    WHEN 'request_hint' THEN 0.10
    WHEN 'submit_report' THEN CASE WHEN n >= 100 THEN 0.50 WHEN n >= 30 THEN 0.30 WHEN n > 0 THEN 0.15 ELSE 0.05 END
    ELSE 0.05 END''')} END AS grade FROM looked)"""


ACTIONS = actions_of(views.select(views.ACTION_LOG, 'events'))
BOTH = f"""{SUBS}, {ACTIONS}, bothg AS (
  SELECT event_id, task_id, grade, 'case' AS kind FROM graded WHERE NOT regexp_matches(task_id, '(^|_)s[^_]*$')
  UNION ALL SELECT event_id, task_id, CAST(grade AS DOUBLE), 'scenario' FROM agrades WHERE regexp_matches(task_id, '(^|_)s[^_]*$'))"""
_kw = m.sql_list(dims.CRITICAL_KEYWORDS)
_summary = next(x for x in views.ACTION_LOG if x.endswith(" AS summary"))


def _mean(where, keys):
    cols = ["tier", "task_id"]
    sel = ", ".join(c if c in keys else f"NULL AS {c}" for c in cols)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return (f"SELECT {sel}, count(*) AS n, CAST(sum(CAST(grade AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_grade, "
            f"count(DISTINCT grade) AS distinct_grades FROM x {group}")


ORACLE = {
    "G1_query_similarity": f"WITH {V3}, k AS (SELECT doc_id, expected IS NULL AS none, {m.norm('submitted')} AS s, {m.norm('expected')} AS e FROM p) SELECT doc_id, CASE WHEN none THEN 0.0::DOUBLE ELSE {m.similarity('s', 'e')} END AS similarity FROM k",
    "G2_critical_keywords": f"SELECT doc_id, array_to_string(list_filter({_kw}, lambda k: contains(lower(text), k)), ',') AS keywords, CAST(len(list_filter({_kw}, lambda k: contains(lower(text), k))) AS INTEGER) AS n_keywords FROM documents",
    "G3_error_type": f"{SUBS} SELECT event_id, CAST({m.error_type('error_type', 'want_type')} AS DOUBLE) AS credit FROM joined",
    "G4_location": f"WITH {V3} SELECT doc_id, CAST({m.location('submitted', 'expected')} AS DOUBLE) AS credit FROM p",
    "G5_explanation": f"SELECT conv_id, turn, CAST({m.explanation('text')} AS DOUBLE) AS credit FROM conversations",
    "G6_confidence": f"{SUBS} SELECT event_id, CAST({m.confidence('confidence')} AS DOUBLE) AS credit FROM joined",
    "G7_easy_grade": f"{SUBS} SELECT event_id, task_id, grade FROM graded WHERE task_id LIKE 'easy%'",
    "G8_medium_grade": f"{SUBS} SELECT event_id, task_id, grade FROM graded WHERE task_id LIKE 'medium%'",
    "G9_hard_grade": f"{SUBS} SELECT event_id, task_id, grade FROM graded WHERE task_id LIKE 'hard%'",
    "G10_action_grade": f"WITH {ACTIONS} SELECT event_id, task_id, action_type, CAST(grade AS DOUBLE) AS grade FROM agrades",
    "G11_dispatch": f"{BOTH} SELECT * FROM bothg",
    "G12_final_report": f"""{ledger.CHAIN}, s AS (SELECT event_id AS sid, length(coalesce(summary, '')) AS n FROM (SELECT event_id, {_summary} FROM events)),
        l AS (SELECT episode_id, CAST(max(baseline) AS DOUBLE) AS base, CAST(arg_max(perf_score, step_no) AS DOUBLE) AS cur, max(step_no) AS steps, arg_max(n, step_no) AS n
              FROM live JOIN s ON sid = event_id GROUP BY episode_id)
        SELECT episode_id, CAST({m.clamp(m.r4('''CASE WHEN base = 0 THEN 0.15::DOUBLE + least(n / 400.0::DOUBLE, 0.25::DOUBLE) ELSE
            greatest(0.0::DOUBLE, (cur - base) / greatest(1.0::DOUBLE, 100.0::DOUBLE - base)) * 0.6::DOUBLE
            + greatest(0.0::DOUBLE, 1.0::DOUBLE - steps / 50.0::DOUBLE) * 0.2::DOUBLE + 0.1::DOUBLE + least(n / 300.0::DOUBLE, 0.1::DOUBLE) END'''))} AS DOUBLE) AS report_score FROM l""",
    "G13_roll_up": f"{BOTH}, x AS (SELECT *, split_part(task_id, '_', 1) AS tier FROM bothg) {_mean('', ['tier', 'task_id'])} UNION ALL {_mean('', ['tier'])} UNION ALL {_mean('', [])}",
}
