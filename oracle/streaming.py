"""Oracles of the streaming jobs: the batch form of the same result."""

from oracle import curriculum, ledger
from tunewright import views

ORACLE = {
    "C6_streaming_steps": f"""{ledger.CHAIN} SELECT episode_id, event_id, step_no, CAST(reward AS DOUBLE) AS reward,
        CAST(total_reward AS DOUBLE) AS total_reward, done FROM live""",
    "C7_streaming_tiers": f"{curriculum.BASE} SELECT learner_id, event_id, episode_no, tier FROM named",
    "C8_streaming_action_counts": f"""SELECT CAST(epoch(time_bucket(INTERVAL '1 hour', ts)) AS BIGINT) AS window_start, action_type, count(*) AS n
        FROM ({views.select(views.EPISODE_STEP, 'events')}) GROUP BY 1, 2""",
    "C8_streaming_sessions": curriculum.ORACLE["C8_idle_sessions"],
    # a delivery is judged by the watermark that the deliveries before it have left
    "C8_streaming_late_rows": """WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
        e AS (SELECT user_id, event_id, epoch_us(ts) AS us, CAST(floor((epoch_us(ts) - lo) * 4 / (hi - lo + 1)) AS INTEGER) + CAST(event_id % 10 = 0 AS INTEGER) AS part FROM events, b),
        w AS (SELECT part, max(max(us) // 1000) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          - CAST(floor(((hi - lo) // 1000000) * 0.05::DOUBLE) AS BIGINT) * 1000 AS mark FROM e, b GROUP BY part, lo, hi)
        SELECT user_id, event_id FROM e JOIN w USING (part) WHERE us // 1000 < mark""",
}
