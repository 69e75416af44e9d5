"""Input views derived from the raw tables.

Each view is a list of plain SQL select expressions, so that the very same text
defines the input of the Spark job and the input of its SQL oracle.
"""

from tunewright.dims import CASES, SCENARIOS, quote


def pick(selector, values):
    """CASE that maps selector 0..n-1 to the given values (last one as ELSE)."""
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values[:-1]))
    return f"CASE {selector} {arms} ELSE {quote(values[-1])} END"


ACTION_OF_EVENT = """CASE event_type
  WHEN 'view' THEN 'inspect_query'
  WHEN 'click' THEN 'create_index'
  WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN 'request_hint' WHEN 1 THEN 'propose_fix' ELSE 'identify_error' END
  WHEN 'error' THEN 'rewrite_query'
  ELSE CASE WHEN event_id % 10 = 0 THEN 'submit_report'
            WHEN event_id % 20 = 5 THEN 'submit_answer'
            WHEN event_id % 20 = 15 THEN 'optimize_query'
            ELSE 'partition_table' END
END"""
PERF_OF_EVENT = ("CAST(CAST(value AS DECIMAL(12,2)) * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(12,4))")

# One row per logged step; the episode is the user.
EPISODE_STEP = [
    "user_id AS episode_id", "event_id", "ts",
    f"{ACTION_OF_EVENT} AS action_type",
    f"{PERF_OF_EVENT} AS perf_score",
]

# Executed SQL text with latency; statements over the tables of this data.
QUERY_LOG = [
    "event_id AS query_id", "user_id", "ts",
    """CASE event_type
  WHEN 'view' THEN concat('SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = ', user_id, ' AND o_orderstatus IN (''O'', ''P'') ORDER BY o_orderdate DESC')
  WHEN 'click' THEN concat('SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem l  WHERE l.l_shipdate BETWEEN DATE ''1995-01-01'' AND DATE ''1995-12-31'' AND l.l_returnflag = ''R'' AND l_discount < 0.0', user_id % 9, ' GROUP BY l_orderkey')
  WHEN 'signup' THEN concat('SELECT c.c_name, n.n_name FROM customer AS c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_custkey = ', user_id)
  WHEN 'purchase' THEN 'SELECT p_brand, count(*) AS n FROM part WHERE p_type LIKE ''%BRASS'' /* only AND p_name = small */ AND 15 > p_size GROUP BY p_brand'
  ELSE concat('SELECT e.value FROM events e WHERE (e.user_id = ', user_id, ' OR e.event_type <> ''it''''s AND ts'') AND e.ts >= TIMESTAMP ''2024-01-15 00:00:00'' -- WHERE event_id = 1')
END AS sql_text""",
    """CASE event_type WHEN 'view' THEN 'orders' WHEN 'click' THEN 'lineitem' WHEN 'signup' THEN 'customer'
  WHEN 'purchase' THEN 'part' ELSE 'events' END AS main_table""",
    "CAST(CAST(value AS DECIMAL(12,2)) * 100 AS DECIMAL(14,2)) AS exec_ms",
]

# Answers to debugging cases: the case is picked by user, the answer by event.
_CASE = f"user_id % {len(CASES)}"
CASE_SUBMISSION = [
    "event_id", "user_id", "ts",
    f"CASE WHEN event_id % 97 = 0 THEN 'nonexistent_task_999' ELSE {pick(_CASE, [c['id'] for c in CASES])} END AS task_id",
    "CASE event_id % 5 "
    f"WHEN 0 THEN {pick(_CASE, [c['fixed_query'] for c in CASES])} "
    f"WHEN 1 THEN concat('  ', lower({pick(_CASE, [c['fixed_query'] for c in CASES])}), '  ') "
    f"WHEN 2 THEN {pick(_CASE, [c['buggy_query'] for c in CASES])} "
    "WHEN 3 THEN concat('SELECT id FROM users WHERE id = ', event_id) ELSE '' END AS fixed_query",
    "CASE event_id % 4 WHEN 0 THEN 'SELECT u.id FROM users u LEFT JOIN orders o ON u.id = o.user_id' "
    "WHEN 1 THEN '' END AS optimized_query",
    "CASE event_id % 6 WHEN 0 THEN 'Fixed' WHEN 1 THEN 'Added the missing join' "
    "WHEN 2 THEN 'Correlated subquery runs per row; use a LEFT JOIN with GROUP BY instead' "
    "WHEN 3 THEN 'The implicit join is a cartesian product: the missing join condition between the two tables makes a cross join of everything' "
    "WHEN 4 THEN 'N+1 pattern: multiple queries are sent, one correlated subquery per row; a join instead needs one scan with HAVING, WHERE and COUNT in order, and uses the index' "
    "END AS explanation",
    "CASE WHEN event_id % 6 = 5 AND event_id % 4 <> 3 THEN 'The correlated subquery became one grouped join' "
    "WHEN event_id % 10 = 0 THEN 'join added' END AS change_made",
    "CASE event_id % 7 WHEN 0 THEN 'syntax' WHEN 1 THEN ' Logic ' WHEN 2 THEN 'performance' "
    "WHEN 3 THEN 'slow scan' WHEN 4 THEN 'wrong result' WHEN 5 THEN 'parse' END AS error_type",
    "CASE event_id % 3 WHEN 0 THEN 'select clause' WHEN 1 THEN 'JOIN type' END AS error_location",
    "CASE event_id % 8 WHEN 0 THEN '0.9' WHEN 1 THEN '1.5' WHEN 2 THEN 'high' WHEN 3 THEN '1' END AS confidence",
    "CASE event_id % 9 WHEN 0 THEN 'many rows are affected' WHEN 1 THEN 'small' END AS impact",
    "CASE event_id % 4 WHEN 2 THEN 'one subquery is executed for every user row' WHEN 3 THEN 'slow' END AS root_cause",
    "CASE event_id % 5 WHEN 2 THEN 'about two hundred times faster' WHEN 3 THEN 'faster' END AS expected_improvement",
    "CASE event_id % 3 WHEN 0 THEN 'replace N+1 by join' END AS optimization_type",
]

# Tuning actions against scenarios.
_SCN = [s["id"] for s in SCENARIOS]
ACTION_LOG = [
    "event_id", "user_id", "ts",
    f"{pick('user_id % 8', _SCN + ['hard_s999', 'easy_s002'])} AS task_id",
    pick("event_id % 12", ["inspect_query", "analyze_indexes", "create_index", "create_index",
                            "rewrite_query", "partition_table", "analyze_statistics", "drop_index",
                            "add_column", "request_hint", "submit_report", "vacuum_table"])
    + " AS action_type",
    "CASE event_id % 5 WHEN 0 THEN 'q1' WHEN 1 THEN ' q2 ' WHEN 2 THEN 'q9' WHEN 3 THEN '' END AS query_id",
    f"CASE WHEN event_id % 7 = 6 THEN 'warehouse_x' WHEN event_id % 7 = 5 THEN 'audit_log' "
    f"ELSE {pick('user_id % 8', [s['tables'][0][0] for s in SCENARIOS] + ['orders', 'orders'])} END AS table_name",
    "CASE event_id % 11 WHEN 0 THEN 'user_id,status' WHEN 1 THEN 'account_id, status' WHEN 2 THEN 'created_at' "
    "WHEN 3 THEN '' WHEN 4 THEN 'email' WHEN 5 THEN 'level,created_at' WHEN 6 THEN 'customer_id,amount' "
    "WHEN 7 THEN 'origin_warehouse,status' WHEN 8 THEN 'phone' WHEN 9 THEN 'id' "
    "ELSE 'account_id,status,created_at' END AS cols",
    "CASE event_id % 11 WHEN 0 THEN 'SELECT c.id, COUNT(t.id) FROM customers c INNER JOIN transactions t ON c.id = t.customer_id WHERE t.amount > 5 GROUP BY c.id' "
    "WHEN 1 THEN 'SELECT * FROM users' WHEN 2 THEN 'SELECT 1' "
    "WHEN 3 THEN 'SELECT id FROM orders FORCE INDEX (idx_user_id) LEFT JOIN users ON true WHERE coalesce(status, 1) = 1 LIMIT 5' "
    "WHEN 4 THEN '' ELSE 'SELECT id, name FROM products WHERE id = 5 LIMIT 10' END AS new_sql",
    "CASE event_id % 2 WHEN 0 THEN 'created_at' END AS partition_column",
    "CASE event_id % 3 WHEN 0 THEN 'PRIMARY' WHEN 1 THEN 'idx_old' END AS index_name",
    "CASE event_id % 2 WHEN 1 THEN 'user_name' END AS column_name",
    "CASE event_id % 7 WHEN 0 THEN 'Indexes added.' WHEN 1 THEN 'Range query indexes added for both events and users tables.' "
    "WHEN 2 THEN 'Three indexes added, the implicit join was rewritten, the audit log is partitioned by date and statistics were refreshed.' END AS summary",
]

# Raw model answers: clean JSON, fenced, wrapped in prose, broken, wrong shape.
_ACTION_JSON = ("concat('{\"action_type\": \"create_index\", \"payload\": {\"table\": \"', "
                + pick("user_id % 6", [s["tables"][0][0] for s in SCENARIOS])
                + ", '\", \"columns\": [\"', "
                + pick("event_id % 5", ["user_id\", \"status", "email", "created_at", "level\", \"created_at", "phone"])
                + ", '\"]}}')")
_INSPECT_JSON = "concat('{\"action_type\": \"inspect_query\", \"payload\": {\"query_id\": \"q', event_id % 4, '\"}}')"
COMPLETION = [
    "event_id AS completion_id", "user_id",
    "CASE event_id % 8 "
    f"WHEN 0 THEN {_ACTION_JSON} "
    f"WHEN 1 THEN concat('```json\n', {_ACTION_JSON}, '\n```') "
    f"WHEN 2 THEN concat('I would run {{this}} first: ', {_ACTION_JSON}, ' and then wait.') "
    f"WHEN 3 THEN concat('  ', {_INSPECT_JSON}, '  ') "
    "WHEN 4 THEN concat('no json here ', event_id) "
    "WHEN 5 THEN concat('{\"action\": \"create_index\", \"payload\": ', props, '}') "
    "WHEN 6 THEN concat('note {\"k\": 1} then {\"action_type\": \"drop_everything\", \"payload\": {\"why\": \"a } in text\"}} done') "
    "ELSE concat('{\"action_type\": \"submit_report\", \"payload\": {\"summary\": \"step ', event_id, '\"}}') END AS completion",
]

# Buggy statements as written by users, with the message they got.
REPAIR = [
    "event_id", "user_id",
    "CASE event_id % 9 "
    "WHEN 0 THEN concat('SELECT p_name p_brand p_size FROM part WHERE p_partkey = ', user_id) "
    "WHEN 1 THEN concat('SELECT s_acctbal FROM supplier name = ''Supplier#', user_id, '''') "
    "WHEN 2 THEN 'SELECT n_nationkey FROM nation WHERE n_name = ''PERU' "
    "WHEN 3 THEN 'SELECT r_name FROM region ORDER r_regionkey' "
    "WHEN 4 THEN 'SELECT c_nationkey, max(c_acctbal) FROM customer GROUP c_nationkey' "
    f"WHEN 5 THEN {quote(CASES[2]['buggy_query'])} "
    f"WHEN 6 THEN {quote(CASES[3]['buggy_query'])} "
    "WHEN 7 THEN concat('SELECT * FROM lineitem WHERE l_tax > 0.01 AND l_orderkey = ', user_id) "
    "ELSE 'SELECT count(*) FROM region' END AS buggy_query",
    "CASE event_id % 9 WHEN 0 THEN 'syntax error: two column names in a row' "
    "WHEN 1 THEN 'syntax error: = where the statement should end' WHEN 2 THEN 'a string has no end' "
    "WHEN 3 THEN 'BY expected after ORDER' WHEN 4 THEN 'BY expected after GROUP' "
    f"WHEN 5 THEN {quote(CASES[2]['error_message'])} WHEN 6 THEN {quote(CASES[3]['error_message'])} "
    "WHEN 7 THEN 'reads more than it returns' ELSE 'rows out of ORDER' END AS error_message",
    "CASE WHEN event_id % 9 < 5 THEN 'syntax' WHEN event_id % 9 < 7 THEN 'logic' ELSE 'performance' END AS category",
]

# Episode scores of learners (one finished episode per event).
LEARNER_SCORE = [
    "user_id AS learner_id", "event_id", "ts",
    # a slow saw-tooth plus noise keeps all tiers reachable
    "CAST(least(0.999, greatest(0.001, CAST((event_id + user_id * 13) % 4000 AS DECIMAL(10,0)) * 0.00025 "
    "+ CAST(value AS DECIMAL(12,2)) * 0.0005)) AS DECIMAL(6,4)) AS score",
]


def select(columns, source):
    """The view as SQL text."""
    return f"SELECT {', '.join(columns)} FROM {source}"


# Statements with typical mistakes, and such as only look like them, for the lint report.
LINT = [
    "event_id",
    "CASE event_id % 8 "
    "WHEN 0 THEN 'SELECT * FROM events WHERE hour(ts) = 7 AND event_type = ''click''' "
    "WHEN 1 THEN 'SELECT s_name, (SELECT max(l_tax) FROM lineitem l WHERE l.l_suppkey = s.s_suppkey) AS top_tax FROM supplier s' "
    "WHEN 2 THEN 'SELECT p.p_name, r.r_name FROM part p, region r WHERE p.p_size > 40' "
    "WHEN 3 THEN 'SELECT l_shipdate, sum(l_tax) AS t FROM lineitem WHERE sum(l_tax) > 1 GROUP BY l_shipdate' "
    "WHEN 4 THEN 'SELECT n_name, row_number() OVER () AS k FROM nation' "
    "WHEN 5 THEN concat('SELECT o.* FROM orders o, customer c WHERE o.o_custkey = c.c_custkey AND c.c_custkey = ', user_id) "
    "WHEN 6 THEN concat('SELECT c_name FROM customer WHERE c_name <> ''SELECT * FROM x, y'' /* upper(c_name) */ AND c_custkey = ', user_id) "
    "ELSE 'SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)' END AS sql_text",
]

# Case that a REPAIR row belongs to (NULL: none).
REPAIR_TASK = ("CASE event_id % 9 WHEN 0 THEN 'easy_001' WHEN 3 THEN 'easy_004' WHEN 5 THEN 'medium_001' "
               "WHEN 6 THEN 'medium_003' WHEN 7 THEN 'hard_003' END AS task_id")

# Answers to debugging tasks as JSON text with fields left out.
ANSWER = [
    "event_id",
    "CASE event_id % 6 "
    "WHEN 4 THEN concat('Here is my answer:\n```json\n{\"action_type\": \"optimize_query\", \"root_cause\": \"step ', user_id, '\", \"expected_improvement\": \"much\"}\n```\nDone.') "
    "WHEN 5 THEN 'Either ```{\"fixed_query\": \"SELECT 7\"}``` or ```json\n{\"fixed_query\": \"SELECT 8\"}\n```' "
    "WHEN 0 THEN concat('{\"action_type\": \"submit_answer\", \"fixed_query\": \"SELECT ', user_id, '\", \"confidence\": 0.5}') "
    "WHEN 1 THEN '```json\n{\"action_type\": \"optimize_query\", \"explanation\": \"uses one scan\"}\n```' "
    "WHEN 2 THEN props ELSE concat('not json ', event_id) END AS answer",
]

# Expert plans: op:target:columns.
PLAN = [
    "event_id",
    "concat('inspect_query:q', event_id % 3 + 1) AS plan_1",
    "concat('create_index:', " + pick("user_id % 6", [s["tables"][0][0] for s in SCENARIOS]) + ", ':', "
    + pick("event_id % 4", ["user_id,status", "email", "created_at,level,kind", "id"]) + ") AS plan_2",
    "CASE WHEN event_id % 2 = 0 THEN 'submit_report' ELSE 'rewrite_query:q2:SELECT a.id FROM a INNER JOIN b ON a.id = b.id' END AS plan_3",
]
