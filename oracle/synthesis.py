"""Oracles of sampling and generation."""

from oracle import macros as m
from tunewright import dims
from tunewright.operators.synthesis import between, draw

S = "seed"
_NAMES = m.sql_list([d for d, _ in dims.DOMAINS])
_TABS = "[" + ", ".join(m.sql_list(ts) for _, ts in dims.DOMAINS) + "]"
_COLS = m.sql_list(dims.FILTER_COLUMNS)


def made(tier, dom=None):
    spec = dims.GENERATOR_TIERS[tier]
    low, high = spec["rows"]
    dom = dom or f"{draw(S, 1)} % 10"
    parts = []
    for i in range(spec["queries"]):
        pick = f"({draw(S, 20 + i)} % {spec['tables']} + 1)"
        c1 = f"{_COLS}[{draw(S, 30 + i)} % 6 + 1]"
        c2 = f"{_COLS}[({draw(S, 30 + i)} % 6 + 1 + {draw(S, 40 + i)} % 5) % 6 + 1]"
        parts.append(f"""SELECT seed, 'gen_{tier}_' || lpad(CAST(seed AS VARCHAR), 10, '0') AS id, '{tier}' AS tier, {_NAMES}[dom + 1] AS domain,
            array_to_string(list_transform(range({spec['tables']}), lambda j: tn[j + 1] || ':' || tr[j + 1] || ':' || (tr[j + 1] // 200)), ',') AS tables,
            {spec['max_steps']} AS max_steps, {between(S, 4, 30, 120)} AS b10, {between(S, 5, spec['target'][0] * 10, spec['target'][1] * 10)} AS t10,
            'q{i + 1}' AS query_id, 'SELECT * FROM ' || tn[{pick}] || ' WHERE ' || {c1} || '=? AND ' || {c2} || '=?' AS sql_text,
            {between(S, 50 + i, 3000, 25000)} AS avg_ms, tr[{pick}] AS rows_examined, {c1} || ',' || {c2} AS hint_columns FROM n""")
    tn = ", ".join(f"{_TABS}[dom + 1][({draw(S, 2)} % 5 + (1 + {draw(S, 3)} % 4) * {j}) % 5 + 1]" for j in range(spec["tables"]))
    tr = ", ".join(between(S, 10 + j, low, high) for j in range(spec["tables"]))
    return (f"(WITH s AS (SELECT c_custkey AS seed FROM customer), d AS (SELECT seed, {dom} AS dom FROM s), "
            f"n AS (SELECT *, [{tn}] AS tn, [{tr}] AS tr FROM d) " + " UNION ALL ".join(parts) + ")")


_PICK = f"row_number() OVER (PARTITION BY p_type ORDER BY {draw('p_partkey', 42)}, p_partkey) <= 5"
_U = m.sql_list(dims.ULTRA_TABLES)

def _step(x, key):
    """One step of the permutation of an r by s rectangle, as nested text."""
    m = lambda c, salt: f"((({c}) % 2147483647 + {salt * 7919 + 1}) * 48271 % 2147483647 + {salt}) * 69621 % 2147483647"
    a1 = f"((({x}) // s + {m(f'(({x}) % s) * 31 + {key}', 1)}) % r)"
    b1 = f"((({x}) % s + {m(f'{a1} * 31 + {key}', 2)}) % s)"
    a2 = f"(({a1} + {m(f'{b1} * 31 + {key}', 3)}) % r)"
    return f"({a2} * s + {b1})"


_CRC_STEP = "list_reduce(list_concat([xor(c, b)], [0::BIGINT for z in range(8)]), lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"
_CRC = f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii((p_size::VARCHAR)[i])::BIGINT for i in range(1, length(p_size::VARCHAR) + 1)]), lambda c, b: {_CRC_STEP}))"

ORACLE = {
    # every place by one step, and those outside the range walk on by a recursive query
    "S2_round_picks": f"""WITH RECURSIVE pool AS (SELECT p_partkey, p_size, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) - 1 AS k, count(*) OVER (PARTITION BY p_size) AS n FROM part),
        sizes AS (SELECT p_size, n, CAST(ceil(sqrt(n)) AS BIGINT) AS r, CAST(ceil(n / ceil(sqrt(n))) AS BIGINT) AS s, CAST({_CRC} % 65536 AS BIGINT) AS c FROM (SELECT DISTINCT p_size, n FROM pool)),
        asked AS (SELECT event_id, CAST(event_id % 50 + 1 AS INTEGER) AS p_size, row_number() OVER (PARTITION BY event_id % 50 ORDER BY ts, event_id) - 1 AS nth FROM events),
        walk(event_id, p_size, round, n, r, s, key, x) AS (
          SELECT event_id, p_size, nth // n, n, r, s, (nth // n) * 131 + c, {_step('nth % n', '((nth // n) * 131 + c)')} FROM asked JOIN sizes USING (p_size)
          UNION ALL SELECT event_id, p_size, round, n, r, s, key, {_step('x', 'key')} FROM walk WHERE x >= n)
        SELECT event_id, walk.p_size, round, p_partkey FROM walk JOIN pool ON pool.p_size = walk.p_size AND pool.k = walk.x WHERE x < walk.n""",
    "S1_stratified_pick": f"SELECT p_partkey, p_type, p_name FROM part QUALIFY {_PICK}",
    "S2_no_repeat_pick": f"""WITH pool AS (SELECT *, bool_and(p_type = 'ECONOMY' OR p_partkey % 3 = 0) OVER (PARTITION BY p_type) AS over FROM part)
        SELECT p_partkey, p_type, p_name FROM pool WHERE over OR NOT (p_type = 'ECONOMY' OR p_partkey % 3 = 0) QUALIFY {_PICK}""",
    "S3_generated_scenarios": f"""SELECT id, tier, domain, tables, max_steps, CAST(b10 AS DOUBLE) / 10 AS baseline, CAST(t10 AS DOUBLE) / 10 AS target, query_id, sql_text,
        avg_ms, rows_examined, hint_columns FROM {made('hard')}""",
    "S4_balanced_batch": f"""SELECT domain, count(*) AS n, CAST(sum(t10) AS BIGINT) AS target_sum FROM {made('medium', 'seed % 10')} WHERE query_id = 'q1' GROUP BY domain""",
    "S5_augmentation": " UNION ALL ".join(
        f"SELECT tier, count(*) AS queries, count(DISTINCT id) AS scenarios, CAST(sum(avg_ms) AS BIGINT) AS ms, max(rows_examined) AS max_rows FROM {made(t)} GROUP BY tier"
        for t in dims.GENERATOR_TIERS),
    "S6_ultra_tier": f"""WITH b AS (SELECT c_custkey AS seed FROM customer),
        u AS (SELECT seed, {between(S, 61, 5, 8)} AS n_tables, {between(S, 62, 4, 6)} AS nq, {between(S, 63, 30, 40)} AS max_steps, {between(S, 64, 650, 720)} AS t10,
          {draw(S, 65)} % 10 AS st, [1, 3, 7, 9][{draw(S, 66)} % 4 + 1] AS stride FROM b),
        n AS (SELECT *, list_transform(range(n_tables), lambda j: {_U}[(st + stride * j) % 10 + 1]) AS names FROM u),
        q AS (SELECT *, unnest(range(1, nq + 1)) AS i FROM n)
        SELECT 'ultra_' || seed AS id, n_tables, max_steps, CAST(t10 AS DOUBLE) / 10 AS target, array_to_string(names, ',') AS tables, 'q' || i AS query_id,
          'SELECT * FROM ' || names[{draw('seed * 31 + i', 70)} % n_tables + 1] || ' WHERE user_id=? AND status=? AND created_at > ?' AS sql_text,
          8000 + {draw('seed * 31 + i', 71)} % 22001 AS avg_ms FROM q""",
}
