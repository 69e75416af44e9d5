"""Oracles of the curriculum operators: recursion over the episode number."""

from tunewright import views

BASE = f"""
WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY ts, event_id) AS episode_no
           FROM ({views.select(views.LEARNER_SCORE, 'events')})),
r AS (SELECT *, CASE WHEN episode_no >= 5 THEN sum(score) OVER (PARTITION BY learner_id ORDER BY episode_no
        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS sum5 FROM s),
walk AS (SELECT learner_id, event_id, episode_no, score, sum5, 0 AS tier_before, 0 AS tier FROM r WHERE episode_no = 1
   UNION ALL
   SELECT r.learner_id, r.event_id, r.episode_no, r.score, r.sum5, walk.tier,
     CASE WHEN r.sum5 >= 3.75 AND walk.tier < 3 THEN walk.tier + 1
          WHEN r.sum5 < 1.5 AND walk.tier > 0 THEN walk.tier - 1 ELSE walk.tier END
   FROM walk JOIN r ON r.learner_id = walk.learner_id AND r.episode_no = walk.episode_no + 1),
named AS (SELECT *, CAST(sum5 AS DOUBLE) / 5 AS mean5, ['easy','medium','hard','ultra'][tier + 1] AS tier_name FROM walk)
"""

ORACLE = {
    "C1_rolling_mean": f"{BASE} SELECT learner_id, event_id, CAST(sum5 AS DOUBLE) / 5 AS mean5 FROM r",
    "C2_tier_walk": f"{BASE} SELECT learner_id, event_id, episode_no, tier FROM named",
    "C3_tier_changes": f"""{BASE} SELECT learner_id, episode_no, CASE WHEN tier > tier_before THEN 'advance' ELSE 'regress' END AS direction,
        tier_name AS new_tier, mean5 FROM named WHERE tier <> tier_before""",
    "C4_learner_stats": f"""{BASE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY episode_no DESC) AS k FROM named),
        moved AS (SELECT *, row_number() OVER (PARTITION BY learner_id ORDER BY episode_no DESC) AS k FROM named WHERE tier <> tier_before),
        h AS (SELECT learner_id, string_agg(episode_no || ':' || tier_name, ',' ORDER BY episode_no) AS t FROM moved WHERE k <= 5 GROUP BY learner_id),
        st AS (SELECT learner_id, max(episode_no) AS episodes_run,
          CAST(round(CAST(CAST(sum(score) FILTER (k <= 5) AS DOUBLE) / count(*) FILTER (k <= 5) AS DECIMAL(18,10)), 3) AS DOUBLE) AS recent_avg,
          CAST(round(CAST(CAST(sum(score) AS DOUBLE) / count(*) AS DECIMAL(18,10)), 3) AS DOUBLE) AS all_time_avg,
          arg_max(tier_name, episode_no) AS current_tier FROM ranked WHERE k <= 20 GROUP BY learner_id)
        SELECT st.*, coalesce(t, '') AS tier_history FROM st LEFT JOIN h ON h.learner_id = st.learner_id""",
    "C5_next_difficulty": f"""{BASE} SELECT learner_id, ['easy','medium','hard'][least(arg_max(tier, episode_no), 2) + 1] AS difficulty
        FROM named GROUP BY learner_id""",
    "C8_idle_sessions": """WITH e AS (SELECT user_id, epoch_us(ts) AS us, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idle FROM events),
        k AS (SELECT *, CAST(sum(CASE WHEN idle IS NULL OR idle >= 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM e)
        SELECT user_id, session, count(*) AS n_events, max(us) - min(us) AS length_us FROM k GROUP BY user_id, session""",
}
