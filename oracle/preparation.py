"""Oracles of validation, preparation and repair."""

from oracle import grading, ledger, synthesis, macros as m, workload
from tunewright import dims, views

# Stated here anew, not read from the jobs.
HINTS = (
    "Hint 1: Start by inspecting your slow queries with inspect_query action.",
    "Hint 2: Use analyze_indexes on tables appearing in slow queries.",
    "Hint 3: Category is 'indexing'. Target score: 85.0.",
)
LOCATIONS = (
    (("SELECT", "COLUMN"), "SELECT clause"),
    (("WHERE", "FILTER"), "WHERE clause"),
    (("JOIN", "ON"), "JOIN condition"),
    (("GROUP", "HAVING"), "GROUP BY / HAVING clause"),
    (("ORDER",), "ORDER BY clause"),
)
SLOW_LOCATION, NO_LOCATION = "Query structure — performance bottleneck", "Unknown location"
FIXES = (
    ("syntax", "Fixed syntax error in the SQL query by correcting the query structure."),
    ("logic", "Fixed logic error by correcting the JOIN type and query conditions."),
    ("performance", "Optimized query performance by restructuring to avoid expensive operations."),
)

ACT = f"WITH a AS ({views.select(views.ACTION_LOG, 'events')})"
_REQ = "(VALUES " + ", ".join(f"({m.lit(k)}, {m.sql_list(v) if v else 'CAST([] AS VARCHAR[])'})" for k, v in dims.REQUIRED_FIELDS.items()) + ") req(act, need)"

PLAIN = "trim(regexp_replace(completion, '```(json)?', '', 'g'))"
COMP = f"""c AS (SELECT *, {PLAIN} AS plain FROM ({views.select(views.COMPLETION, 'events')})),
j AS (SELECT completion_id, CASE WHEN json_valid(plain) AND json_extract_string(plain, '$.action_type') IS NOT NULL THEN plain
        ELSE nullif(regexp_extract(plain, '\\{{"action_type".*\\}}', 0), '') END AS aj FROM c)"""

_SID = m.sql_list([s["id"] for s in dims.SCENARIOS])
_FROM_TEXT = f"""SELECT completion_id AS event_id, {_SID}[completion_id % {len(dims.SCENARIOS)} + 1] AS task_id, json_extract_string(aj, '$.action_type') AS action_type,
   json_extract_string(aj, '$.payload.query_id') AS query_id, json_extract_string(aj, '$.payload.table') AS table_name,
   coalesce(array_to_string(CAST(json_extract(aj, '$.payload.columns') AS VARCHAR[]), ','), '') AS cols, json_extract_string(aj, '$.payload.new_sql') AS new_sql,
   json_extract_string(aj, '$.payload.partition_column') AS partition_column, json_extract_string(aj, '$.payload.index_name') AS index_name,
   json_extract_string(aj, '$.payload.column_name') AS column_name, json_extract_string(aj, '$.payload.summary') AS summary FROM j"""

REP = f"""r0 AS ({views.select(views.REPAIR + [views.REPAIR_TASK], 'events')}),
r1 AS (SELECT *, CASE WHEN contains(lower(error_message), 'syntax error') AND contains(lower(error_message), 'name')
     THEN regexp_replace(buggy_query, '(?i)SELECT\\s+(\\w+)\\s+(\\w+)', 'SELECT \\1, \\2', 'g') ELSE buggy_query END AS s1 FROM r0),
r2 AS (SELECT *, CASE WHEN NOT contains(upper(s1), 'WHERE') AND contains(s1, '=') THEN replace(replace(s1, ' id =', ' WHERE id ='), ' name =', ' WHERE name =') ELSE s1 END AS s2 FROM r1),
r3 AS (SELECT *, CASE WHEN (length(s2) - length(replace(s2, '''', ''))) % 2 <> 0 THEN s2 || '''' ELSE s2 END AS s3 FROM r2),
r4 AS (SELECT *, CASE WHEN regexp_matches(s3, '(?i)\\bORDER\\s+BY') THEN s3 ELSE regexp_replace(s3, '(?i)\\bORDER\\s+(\\w)', 'ORDER BY \\1', 'g') END AS s4 FROM r3),
r5 AS (SELECT *, CASE WHEN regexp_matches(s4, '(?i)\\bGROUP\\s+BY') THEN s4 ELSE regexp_replace(s4, '(?i)\\bGROUP\\s+(\\w)', 'GROUP BY \\1', 'g') END AS s5,
   regexp_replace(replace(buggy_query, 'INNER JOIN', 'LEFT JOIN'), '(?i)WHERE\\s+(AVG|SUM|COUNT|MAX|MIN)\\s*\\(', 'HAVING \\1(', 'g') AS l1 FROM r4),
rep AS (SELECT *, CASE category WHEN 'syntax' THEN s5 WHEN 'logic' THEN l1 ELSE replace(buggy_query, 'SELECT *', 'SELECT id, name, status, created_at') END AS fixed,
   CASE {' '.join('WHEN ' + ' OR '.join(f"contains(upper(error_message), '{w}')" for w in ws) + f" THEN {m.lit(p)}" for ws, p in LOCATIONS)}
     ELSE CASE WHEN category = 'performance' THEN {m.lit(SLOW_LOCATION)} ELSE {m.lit(NO_LOCATION)} END END AS place FROM r5),
exp AS (SELECT *, CASE WHEN buggy_query = fixed THEN 'Analyzed the ' || category || ' issue. The query may require deeper inspection.'
   ELSE (CASE category {' '.join(f"WHEN '{k}' THEN {m.lit(v)}" for k, v in FIXES)} END)
     || ' Original: ''' || left(buggy_query, 60) || '...'' Fixed: ''' || left(fixed, 60) || '...''' END AS explanation FROM rep)"""
_CASE_ID = "CASE category WHEN 'syntax' THEN 'easy_' WHEN 'logic' THEN 'medium_' ELSE 'hard_' END || event_id"
_board = f"""brd AS (SELECT event_id, task_id, CASE WHEN category <> 'performance' THEN fixed END AS fixed_query, CASE WHEN category = 'performance' THEN fixed END AS optimized_query,
   explanation, category AS error_type, CASE WHEN category <> 'performance' THEN place END AS error_location, '0.6' AS confidence, CAST(NULL AS VARCHAR) AS impact,
   CASE WHEN category = 'performance' THEN 'Performance issue detected: ' || left(error_message, 100) END AS root_cause,
   CASE WHEN category = 'performance' THEN 'Significant reduction in query execution time' END AS expected_improvement,
   CASE WHEN category = 'performance' THEN 'Fix performance issue: performance' END AS optimization_type, CAST(NULL AS VARCHAR) AS change_made FROM exp WHERE task_id IS NOT NULL),
   {m.graded('brd')}"""
_task1 = next(x for x in views.ACTION_LOG if x.endswith(" AS task_id"))
_task2 = next(x for x in views.CASE_SUBMISSION if x.endswith(" AS task_id"))
ANS = f"""WITH a AS (SELECT event_id, trim(CASE WHEN contains(answer, '```') THEN regexp_replace(string_split(answer, '```')[2], '^json', '') ELSE answer END, ' ' || chr(10)) AS t FROM ({views.select(views.ANSWER, 'events')})),
  b AS (SELECT *, NOT json_valid(t) AS broken, CASE WHEN json_valid(t) THEN t END AS v FROM a),
  o AS (SELECT *, NOT broken AND coalesce(json_extract_string(v, '$.action_type'), '') = 'optimize_query' AS opt FROM b)"""


def _j(name):
    return f"json_extract_string(v, '$.{name}')"


ORACLE = {
    "P1_redaction": """SELECT doc_id, lang, source, '{"type":"' || lang || '","impact":"' || source || '"}' AS issue, source AS sample FROM documents""",
    "P2_leak_check": "SELECT b.item_id, count(*) AS n_docs FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY b.item_id",
    "P3_domain_check": f"""{ACT} SELECT event_id, action_type, CASE WHEN action_type IN ({', '.join(m.lit(x) for x in dims.ACTIONS)}) THEN 'accepted' ELSE 'quarantine' END AS route,
        CASE WHEN action_type NOT IN ({', '.join(m.lit(x) for x in dims.ACTIONS)}) THEN 0.05::DOUBLE END AS score FROM a""",
    "P4_required_fields": f"""WITH {COMP}, k AS (SELECT completion_id, json_extract_string(aj, '$.action_type') AS action_type, json_keys(aj, '$.payload') AS have FROM j WHERE aj IS NOT NULL)
        SELECT completion_id, action_type, array_to_string(list_sort(list_filter(need, lambda x: NOT list_contains(have, x))), ',') AS missing
        FROM k LEFT JOIN {_REQ} ON act = action_type""",
    "P5_truncation": "SELECT doc_id, CAST(length(t) AS INTEGER) AS n, md5(t) AS digest FROM (SELECT doc_id, CASE WHEN length(text) > 5000 THEN text[1:5000] || '...[truncated]' ELSE text END AS t FROM documents)",
    "P6_null_actions": f"""WITH e AS (SELECT episode_id, event_id, ts, CASE WHEN event_id % 13 <> 0 THEN action_type END AS act FROM ({views.select(views.EPISODE_STEP, 'events')})),
        n AS (SELECT *, row_number() OVER w AS step_no, count(act) OVER w AS history FROM e WINDOW w AS (PARTITION BY episode_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
        SELECT episode_id, event_id, step_no, CASE WHEN act IS NULL THEN 0.001::DOUBLE ELSE CAST(CASE act {ledger._rewards} ELSE 0.05 END AS DOUBLE) END AS reward, history FROM n""",
    "P7_clamp": f"SELECT event_id, CAST({m.clamp(m.r4('value / 100'))} AS DOUBLE) AS score FROM events",
    "P8_routing": f"""WITH i AS (SELECT event_id, {_task1} FROM events UNION ALL SELECT event_id, {_task2} FROM events)
        SELECT event_id, task_id, CASE WHEN string_split(task_id, '_')[-1][1] = 's' THEN 'scenario' ELSE 'case' END AS kind, split_part(task_id, '_', 1) AS tier FROM i""",
    "P9_lookup": "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "P10_progressive_hint": f"""WITH raw AS ({views.select(views.EPISODE_STEP, 'events')}),
        k AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY ts, event_id) AS hint_no FROM raw WHERE action_type = 'request_hint')
        SELECT episode_id, event_id, hint_no, {m.sql_list(HINTS)}[least(hint_no, 3)] AS hint FROM k""",
    "P11_task_catalogue": f"""SELECT CASE WHEN p_size <= 15 THEN 'easy' WHEN p_size <= 30 THEN 'medium' ELSE 'hard' END AS tier, count(*) AS n_tasks,
        count(DISTINCT p_name) AS n_descriptions, CAST(max(p_size) AS BIGINT) AS max_size, {m.lit(','.join(sorted(dims.ACTIONS)))} AS actions FROM part GROUP BY 1""",
    "P1_visible_scenarios": f"""WITH q AS (SELECT * FROM {synthesis.made('medium')}) SELECT id AS scenario_id, 'indexing' AS category,
          list_aggregate(list_transform(string_split(any_value(tables), ','), lambda t: split_part(t, ':', 1)), 'string_agg', ',') AS tables, string_agg(sql_text, ';' ORDER BY query_id) AS statements,
          'category,description,max_steps,performance_score_baseline,scenario_id,slow_queries,tables,target_score' AS fields FROM q GROUP BY id""",
    "P1_visible_cases": f"""WITH {REP} SELECT {_CASE_ID} AS id, buggy_query, category AS error_type_hint, CAST(CASE WHEN event_id % 2 = 0 THEN 3 ELSE 5 END AS INTEGER) AS estimated_steps,
          CASE WHEN category = 'performance' THEN '{{"type":"scan","impact":"slow"}}' END AS issue, '{{"k":' || event_id || '}}' AS expected_output_sample,
          'buggy_query,category,database_schema,error_message,error_type_hint,estimated_steps,expected_output_sample,id,performance_issue' AS fields FROM exp""",
    "P10_case_hints": f"""WITH {REP} SELECT event_id, CAST(event_id % 4 + 1 AS INTEGER) AS asked, CASE event_id % 4 WHEN 0 THEN 'Hint 1: The error is in the ' || place || '.'
          WHEN 1 THEN 'Hint 2: This is a ' || category || ' error. Category: ' || category || '.' ELSE 'Hint 3: Fix: ' || fixed END AS hint FROM exp""",
    "P11_task_list": f"""WITH {REP}, q AS (SELECT DISTINCT id, domain FROM {synthesis.made('medium')}), t AS (
          SELECT id, 'Slow statements of a ' || domain AS description, 0 AS ord FROM q UNION ALL SELECT {_CASE_ID}, 'Repair a statement of user ' || user_id, 1 FROM exp)
        SELECT id, split_part(id, '_', 1) AS tier, description, CAST(ord AS INTEGER) AS ord, {m.lit(','.join(dims.ACTIONS))} AS actions FROM t""",
    "T1_scenario_prompt": f"""WITH l AS ({views.select(views.QUERY_LOG, 'events')}),
        t AS (SELECT user_id, {workload._fp('sql_text')} AS template, main_table, max(exec_ms) AS ms, arg_max(sql_text, (exec_ms, -query_id)) AS sql, count(*) AS n, sum(exec_ms) AS s FROM l GROUP BY 1, 2, 3),
        q AS (SELECT t.*, row_count, row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, template) AS k FROM t LEFT JOIN {workload.COUNTS} ON name = main_table),
        p AS (SELECT user_id, string_agg('{{"id":"q' || k || '","sql":"' || sql || '","ms":' || CAST(ms AS VARCHAR) || ',"main_table":"' || main_table || '"}}', ',' ORDER BY k) AS qs, sum(s) AS s, sum(n) AS n FROM q GROUP BY 1),
        e AS (SELECT DISTINCT user_id, main_table, row_count FROM q),
        h AS (SELECT user_id, string_agg('{{"table":"' || wt || '","columns":"' || wc || '"}}', ',' ORDER BY wt, wc) AS hs FROM e JOIN {workload.WANTED} ON wt = main_table GROUP BY 1),
        d AS (SELECT user_id, string_agg('{{"name":"' || main_table || '","rows":' || row_count || '}}', ',' ORDER BY main_table) AS ts, coalesce(any_value(hs), '') AS hs FROM e LEFT JOIN h USING (user_id) GROUP BY 1)
        SELECT p.user_id, {m.lit(dims.SYSTEM_INSTRUCTION)} || chr(10) || '=== DATABASE STATE ===' || chr(10) || 'Scenario: user ' || p.user_id || chr(10) || 'Tables: [' || ts || ']' || chr(10)
          || 'Slow Queries: [' || qs || ']' || chr(10) || 'Missing Index Hints: [' || hs || ']' || chr(10)
          || 'Performance: mean ' || printf('%.2f', CAST(round(CAST(CAST(s AS DOUBLE) / n AS DECIMAL(18,6)), 2) AS DOUBLE)) || ' ms, target score {dims.DEFAULT_TARGET}' || chr(10)
          || 'What is your next action? JSON only:' AS prompt FROM p JOIN d USING (user_id)""".replace("{{", "{").replace("}}", "}"),
    "T2_case_prompt": f"""WITH r AS ({views.select(views.REPAIR, 'events')}) SELECT event_id, 'Task: repair ' || event_id || chr(10) || 'Buggy Query:' || chr(10) || buggy_query || chr(10) || 'Error Message:' || chr(10)
        || error_message || chr(10) || 'Database Schema:' || chr(10) || '{{"users":["id INT","name VARCHAR(100)"]}}' || chr(10) || 'Category: ' || category || chr(10)
        || 'Analyze the buggy query and provide your fix as a JSON object.' AS prompt FROM r""",
    "T3_action_extraction": f"""WITH {COMP} SELECT completion_id, CASE WHEN aj IS NULL THEN 'quarantine' ELSE 'accepted' END AS route, json_extract_string(aj, '$.action_type') AS action_type,
        json_extract_string(aj, '$.payload.table') AS table_name, coalesce(array_to_string(CAST(json_extract(aj, '$.payload.columns') AS VARCHAR[]), ','), '') AS columns FROM j""",
    "T4_action_defaults": f"""{ANS} SELECT event_id, CASE WHEN broken THEN 'identify_error' WHEN opt THEN 'optimize_query' ELSE 'submit_answer' END AS action_type,
        CASE WHEN broken THEN NULL WHEN opt THEN coalesce({_j('optimized_query')}, 'SELECT 1') ELSE coalesce({_j('fixed_query')}, 'SELECT 1') END AS query,
        CASE WHEN broken THEN 'LLM call failed, using fallback' ELSE coalesce({_j('explanation')}, '') END AS explanation,
        CASE WHEN opt THEN coalesce({_j('optimization_type')}, 'Performance fix') ELSE coalesce({_j('error_type')}, 'syntax') END AS kind,
        CASE WHEN opt THEN NULL ELSE coalesce({_j('error_location')}, 'unknown') END AS error_location,
        CASE WHEN opt THEN coalesce({_j('root_cause')}, '') END AS root_cause, CASE WHEN opt THEN coalesce({_j('expected_improvement')}, '') END AS expected_improvement,
        CASE WHEN NOT broken THEN coalesce(CAST({_j('confidence')} AS DOUBLE), 0.7::DOUBLE) END AS confidence FROM o""",
    "T5_plan_expansion": f"""WITH p AS ({views.select(views.PLAN, 'events')}), u AS (SELECT event_id, 1 AS step, plan_1 AS item FROM p UNION ALL SELECT event_id, 2, plan_2 FROM p UNION ALL SELECT event_id, 3, plan_3 FROM p),
        s AS (SELECT event_id, step, split_part(item, ':', 1) AS op, nullif(split_part(item, ':', 2), '') AS target, nullif(split_part(item, ':', 3), '') AS argument FROM u)
        SELECT *, CAST(CASE WHEN op = 'create_index' THEN len(string_split(argument, ',')) ELSE 0 END AS INTEGER) AS n_columns FROM s""",
    "T6_trajectories": f"""{ledger.CHAIN} SELECT episode_id, step_no AS step, 'You are a senior database engineer.' || chr(10) || 'Current DB state:' || chr(10) || '- Performance score: '
        || printf('%.2f', CAST(round(perf_score - delta, 2) AS DOUBLE)) || ' / 85' || chr(10) || '- Steps remaining: ' || (51 - step_no) || chr(10) || 'Choose the best next action as JSON:' AS prompt,
        action_type, CAST({m.clamp('round((reward + 1) * 0.5, 4)')} AS DOUBLE) AS reward, CAST(delta AS DOUBLE) AS db_delta FROM live""",
    "T7_completion_scores": f"""WITH {COMP}, {grading.actions_of(_FROM_TEXT)} SELECT event_id AS completion_id, task_id AS scenario_id,
        CASE WHEN action_type IS NULL THEN 0.001::DOUBLE WHEN action_type NOT IN ({', '.join(m.lit(x) for x in dims.TRAINER_ACTIONS)}) THEN 0.05::DOUBLE ELSE CAST(grade AS DOUBLE) END AS reward FROM agrades""",
    "T8_sql_repair": f"WITH {REP} SELECT event_id, category, fixed AS fixed_query FROM exp",
    "T9_error_location": f"WITH {REP} SELECT event_id, place AS error_location FROM exp",
    "T10_fix_explanation": f"WITH {REP} SELECT event_id, explanation FROM exp",
    "T11_repair_scoreboard": f"""WITH {REP}, {_board} SELECT split_part(task_id, '_', 1) AS tier, count(*) AS n,
        CAST(sum(CAST(grade AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_grade FROM graded GROUP BY 1""",
}
