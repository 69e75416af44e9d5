"""Oracles of the metric operators."""

from oracle import macros as m


def _avg(cond):
    return f"CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) FILTER ({cond}) AS DOUBLE) / count(*) FILTER ({cond})"


def _gain(x):
    return f"round(CAST(greatest(0.0::DOUBLE, coalesce({x}, base) - base) AS DECIMAL(18,10)), 4)"


BASE = f"""WITH per AS (SELECT c_nationkey AS scenario_no, {_avg('true')} AS base, {_avg("c_mktsegment = 'BUILDING'")} AS a,
   {_avg("c_mktsegment = 'MACHINERY'")} AS b FROM customer GROUP BY 1),
p AS (SELECT scenario_no, {_gain('a')} AS random, {_gain('b')} AS strategic FROM per)"""
DAILY = """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day,
   round(CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS DECIMAL(18,10)), 6) AS v FROM events GROUP BY 1, 2)"""
ORACLE = {
    "M1_policy_comparison": f"{BASE} SELECT scenario_no, CAST(random AS DOUBLE) AS random, CAST(strategic AS DOUBLE) AS strategic, strategic > random AS wins FROM p",
    "M2_relative_gain": f"""{BASE}, a AS (SELECT CAST(sum(random) AS DOUBLE) / count(*) AS r, CAST(sum(strategic) AS DOUBLE) / count(*) AS s FROM p)
        SELECT CAST({m.r4('r')} AS DOUBLE) AS avg_r, CAST({m.r4('s')} AS DOUBLE) AS avg_s,
          CASE WHEN r < 0.01 THEN 'inf' ELSE printf('%.2f', CAST({m.r4('(s - r) / greatest(r, 0.001::DOUBLE) * 100')} AS DOUBLE)) END AS relative_gain FROM a""",
    "M3_cumulative_mean": f"""{BASE}, l AS (SELECT 'random' AS policy, scenario_no, random AS gain FROM p UNION ALL SELECT 'strategic', scenario_no, strategic FROM p)
        SELECT policy, scenario_no, CAST({m.r4('CAST(sum(gain) OVER w AS DOUBLE) / count(*) OVER w')} AS DOUBLE) AS running_mean FROM l
        WINDOW w AS (PARTITION BY policy ORDER BY scenario_no ROWS UNBOUNDED PRECEDING)""",
    "M4_outliers": """WITH per AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
        SELECT o_custkey, n FROM per WHERE abs(n - (SELECT avg(n) FROM per)) > 1.5 * (SELECT stddev_pop(n) FROM per)""",
    "M5_moving_average": f"""{DAILY}, r AS (SELECT *, row_number() OVER w AS step, CAST(sum(v) OVER (w ROWS 9 PRECEDING) AS DOUBLE) / 10 AS mean FROM d
        WINDOW w AS (PARTITION BY event_type ORDER BY day))
        SELECT event_type, strftime(day, '%Y-%m-%d') AS day, CAST({m.r4('mean')} AS DOUBLE) AS mean FROM r WHERE step >= 10""",
    "M6_first_last_change": f"""{DAILY}, e AS (SELECT event_type, CAST(arg_min(v, day) AS DOUBLE) AS a, CAST(arg_max(v, day) AS DOUBLE) AS b FROM d GROUP BY 1)
        SELECT event_type, a AS first_value, b AS last_value, CAST({m.amount4('(b - a) / greatest(abs(a), 1e-9) * 100')} AS DOUBLE) AS change_pct FROM e""",
    "M9_best_worst": f"""{BASE} SELECT (SELECT scenario_no FROM p ORDER BY strategic DESC, scenario_no LIMIT 1) AS best_scenario, (SELECT CAST(max(strategic) AS DOUBLE) FROM p) AS best_gain,
        (SELECT scenario_no FROM p ORDER BY strategic, scenario_no LIMIT 1) AS worst_scenario, (SELECT CAST(min(strategic) AS DOUBLE) FROM p) AS worst_gain""",
}
