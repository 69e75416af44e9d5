"""Oracles of the reward ledger."""

from oracle import macros as m
from tunewright import dims, views

_rewards = " ".join(f"WHEN {m.lit(k)} THEN {v}" for k, v in dims.STEP_REWARD.items())
_share = " ".join(f"WHEN {m.lit(k)} THEN {v}" for k, v in dims.GRADE_SHARE.items())
D = "DECIMAL(18,4)"


def _mile(share):
    return (f"(gained >= {share} * gap AND coalesce(gained_before, -1000) < {share} * gap "
            "AND gained IS NOT NULL)")


CHAIN = f"""
WITH raw AS ({views.select(views.EPISODE_STEP, 'events')}),
v1 AS (SELECT *, CAST(row_number() OVER (PARTITION BY episode_id ORDER BY ts, event_id) AS BIGINT) AS step_no
       FROM raw QUALIFY step_no <= 50),
subs AS (SELECT * FROM ({views.select(views.CASE_SUBMISSION, 'events')})),
{m.graded('subs')},
g AS (SELECT event_id AS gid, grade FROM graded),
v2 AS (SELECT v1.*, CASE WHEN action_type IN ('submit_answer','optimize_query','propose_fix','identify_error')
                    THEN CAST(g.grade AS {D}) END AS grade,
         first_value(perf_score) OVER w AS baseline,
         coalesce(perf_score - lag(perf_score) OVER w, 0) AS delta,
         step_no - row_number() OVER (PARTITION BY episode_id, action_type ORDER BY ts, v1.event_id) AS island
       FROM v1 LEFT JOIN g ON g.gid = v1.event_id
       WINDOW w AS (PARTITION BY episode_id ORDER BY ts, v1.event_id)),
v3 AS (SELECT *, row_number() OVER (PARTITION BY episode_id, action_type, island ORDER BY step_no) AS run_pos,
         CASE WHEN baseline > 0 AND perf_score > 0 THEN perf_score - baseline END AS gained,
         greatest(1, 100 - baseline) AS gap,
         action_type IN ('submit_answer','optimize_query','submit_report') AS is_terminal
       FROM v2),
v4 AS (SELECT *,
         max(gained) OVER (PARTITION BY episode_id ORDER BY step_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gained_before,
         CAST(sum(CASE WHEN action_type = 'request_hint' THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id ORDER BY step_no) AS BIGINT) AS hints_used,
         max(perf_score) OVER (PARTITION BY episode_id ORDER BY step_no) AS best_perf
       FROM v3),
v5 AS (SELECT *,
         CAST(CASE action_type {_rewards} ELSE {dims.DEFAULT_STEP} END AS {D}) AS step_reward,
         CAST(CASE WHEN delta <> 0 THEN greatest(-0.40, least(0.40, round(delta * 0.004, 4))) ELSE 0 END AS {D}) AS delta_reward,
         CAST((CASE WHEN {_mile('0.25')} THEN 0.15 ELSE 0 END) + (CASE WHEN {_mile('0.50')} THEN 0.25 ELSE 0 END)
            + (CASE WHEN {_mile('0.75')} THEN 0.40 ELSE 0 END) AS {D}) AS milestone_bonus,
         concat_ws(',', CASE WHEN {_mile('0.25')} THEN '0.25' END, CASE WHEN {_mile('0.50')} THEN '0.50' END,
                        CASE WHEN {_mile('0.75')} THEN '0.75' END) AS milestones,
         CAST(CASE WHEN run_pos >= 2 THEN -0.08 * least(run_pos - 1, 3) ELSE 0 END AS {D}) AS loop_penalty,
         CAST(CASE WHEN action_type = 'request_hint' THEN -0.10 ELSE 0 END AS {D}) AS hint_penalty,
         CAST(CASE WHEN delta < -1 THEN -0.05 ELSE 0 END AS {D}) AS backtrack_penalty,
         CAST(CASE WHEN step_no >= 48 AND NOT is_terminal THEN -0.15 ELSE 0 END AS {D}) AS budget_penalty,
         CAST(CASE WHEN step_no <= 35 AND ((action_type = 'submit_report' AND gained IS NOT NULL)
                     OR (action_type IN ('submit_answer','optimize_query') AND grade >= 0.5))
              THEN (50 - step_no) * 0.002 ELSE 0 END AS {D}) AS efficiency_bonus,
         CAST(CASE WHEN action_type <> 'submit_report' THEN 0
              WHEN gained IS NULL THEN 0.10
              ELSE {m.clamp(m.r4("CAST(gained AS DOUBLE) / CAST(gap AS DOUBLE) * 0.6::DOUBLE + (1.0::DOUBLE - CAST(step_no AS DOUBLE) / 50.0::DOUBLE) * 0.2::DOUBLE + 0.1::DOUBLE"))} END AS {D}) AS terminal_score,
         CAST(coalesce(round(grade * (CASE action_type {_share} END), 4), 0) AS {D}) AS grader_part,
         (is_terminal OR step_no >= 50 OR coalesce(grade, 0) >= 1 OR perf_score >= 85) AS done
       FROM v4),
v6 AS (SELECT *, {m.clamp('step_reward + delta_reward + milestone_bonus + terminal_score + grader_part + efficiency_bonus + loop_penalty + hint_penalty + backtrack_penalty + budget_penalty')} AS reward
       FROM v5),
led AS (SELECT *, step_no > min(CASE WHEN done THEN step_no END) OVER (PARTITION BY episode_id) IS TRUE AS finished_before,
          CAST(sum(reward) OVER (PARTITION BY episode_id ORDER BY step_no) AS {D}) AS total_reward
        FROM v6),
live AS (SELECT * FROM led WHERE NOT finished_before)
"""
_DECIMALS = {"step_reward", "perf_score", "delta", "delta_reward", "baseline", "milestone_bonus", "loop_penalty",
             "hint_penalty", "backtrack_penalty", "budget_penalty", "efficiency_bonus", "terminal_score", "grade",
             "grader_part", "reward", "total_reward"}


def _cols(*names, source="live"):
    cols = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if n in _DECIMALS else n for n in names)
    return f"{CHAIN} SELECT episode_id, event_id, step_no, {cols} FROM {source}"


_PARTS = ("step_reward", "delta_reward", "milestone_bonus", "terminal_score", "grader_part", "efficiency_bonus",
          "loop_penalty", "hint_penalty", "backtrack_penalty", "budget_penalty")

SUMMARY = f"""{CHAIN} SELECT episode_id, count(*) AS total_steps, CAST(sum(reward) AS DOUBLE) AS total_reward,
  max(hints_used) AS hints_used,
  CAST(round(CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DECIMAL(20,0)) * 0.000001, 2) AS DOUBLE) AS duration_sec,
  CAST(arg_max(perf_score, step_no) AS DOUBLE) AS final_score, CAST(max(baseline) AS DOUBLE) AS baseline_score,
  CAST(round(arg_max(perf_score, step_no) - max(baseline), 2) AS DOUBLE) AS improvement,
  CAST(max(best_perf) AS DOUBLE) AS best_score,
  coalesce(string_agg(milestones, ',' ORDER BY milestones) FILTER (milestones <> ''), '') AS milestones,
  bool_or(done) AS done
FROM live GROUP BY episode_id"""

ORACLE = {
    "E1_step_reward": _cols("action_type", "step_reward"),
    "E2_score_delta": _cols("perf_score", "delta"),
    "E3_delta_reward": _cols("delta", "delta_reward"),
    "E4_milestones": _cols("baseline", "perf_score", "milestone_bonus", "milestones"),
    "E5_loop_penalty": _cols("action_type", "run_pos", "loop_penalty"),
    "E6_hint_penalty": _cols("hints_used", "hint_penalty"),
    "E7_backtrack_penalty": _cols("delta", "backtrack_penalty"),
    "E8_budget_penalty": _cols("is_terminal", "budget_penalty"),
    "E9_efficiency_bonus": _cols("action_type", "efficiency_bonus"),
    "E10_terminal_score": _cols("action_type", "terminal_score"),
    "E11_grader_part": _cols("action_type", "grade", "grader_part"),
    "E12_step_total": f"""{CHAIN} SELECT episode_id, event_id, step_no, CAST(reward AS DOUBLE) AS reward,
        concat_ws(';', {', '.join(f"CASE WHEN {p} <> 0 THEN '{p}=' || printf('%.4f', CAST({p} AS DOUBLE)) END" for p in _PARTS)}) AS breakdown
        FROM live""",
    "E13_running_total": _cols("reward", "total_reward", source="live"),
    "E14_external_reward": f"""{CHAIN} SELECT episode_id, event_id, step_no, CAST(reward AS DOUBLE) AS reward,
        CAST({m.clamp('round((reward + 1) * 0.5, 4)')} AS DOUBLE) AS external_reward FROM live""",
    "E15_done": _cols("done"),
    "E16_truncate_after_done": _cols("action_type", "done", source="live"),
    "E17_episode_summary": SUMMARY,
    "E18_progress": f"""{CHAIN} SELECT episode_id, string_agg(printf('%.4f', CAST(perf_score AS DOUBLE)), ',' ORDER BY step_no) AS history,
        CAST(max(best_perf) AS DOUBLE) AS best_score, greatest(0, 50 - max(step_no)) AS budget_remaining,
        CAST(sum(reward) AS DOUBLE) AS total_reward FROM live GROUP BY episode_id""",
    "E19_latest_state": f"""{CHAIN}, c AS (SELECT episode_id, action_type || '=' || count(*) AS t FROM live GROUP BY episode_id, action_type),
        k AS (SELECT episode_id, string_agg(t, ';' ORDER BY t) AS action_counts FROM c GROUP BY episode_id)
        SELECT live.episode_id, step_no AS step_count, event_id AS last_event, action_type AS last_action,
               CAST(reward AS DOUBLE) AS last_reward, action_counts
        FROM live JOIN k ON k.episode_id = live.episode_id
        QUALIFY row_number() OVER (PARTITION BY live.episode_id ORDER BY step_no DESC) = 1""",
    "E22_run_score": f"""{CHAIN}, a AS (SELECT episode_id, count(*) AS steps, greatest(0, least(1, round(sum(reward) * 0.1, 4))) AS sc
        FROM live WHERE step_no <= 10 GROUP BY episode_id)
        SELECT episode_id, steps, CAST(sc AS DOUBLE) AS score, sc >= 0.5 AS success FROM a""",
    "W16_best_so_far": f"""WITH raw AS ({views.select(views.EPISODE_STEP, 'events')})
        SELECT episode_id, event_id, row_number() OVER w AS step_no, CAST(max(perf_score) OVER w AS DOUBLE) AS best_score, perf_score >= 85 AS target_reached
        FROM raw WINDOW w AS (PARTITION BY episode_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "M7_reward_stats": f"""{CHAIN} SELECT CAST(sum(reward) AS DOUBLE) / count(*) AS avg_reward, CAST(max(reward) AS DOUBLE) AS max_reward,
        CAST(min(reward) AS DOUBLE) AS min_reward, count(*) AS steps, count(DISTINCT episode_id) AS episodes FROM live""",
    "M8_valid_series": f"""{CHAIN} SELECT episode_id, CAST(arg_min(reward, step_no) AS DOUBLE) AS first_reward,
        CAST(arg_max(reward, step_no) AS DOUBLE) AS last_reward, count(*) AS valid_steps
        FROM live WHERE reward > 0.001 GROUP BY episode_id""",
}
