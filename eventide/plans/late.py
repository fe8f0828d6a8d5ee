"""Late-data queries on a deterministic disordered arrival of ``events``
(arrival = ts + (event_id * 7919 mod 10800) s, micro-batch = arrival hour)."""

from __future__ import annotations


from eventide.operators.late import (
    disordered_arrival,
    early_fire_counts,
    firing_grid,
    lateness_classes,
    lateness_firings,
    split_late_records,
    split_late_windows,
)
from eventide.plans.registry import ARRIVAL, query, tumble_end
from eventide.sources.tables import load

WM_CTE = f"""
a AS (SELECT *, {ARRIVAL} AS arrival, time_bucket(INTERVAL '1 hour', {ARRIVAL}) AS batch FROM events),
b AS (SELECT batch, max(ts) AS mx FROM a GROUP BY batch),
w AS (SELECT batch, max(mx) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm FROM b),
x AS (SELECT a.*, w.wm FROM a JOIN w USING (batch))
"""


def _arrived(spark, d):
    ev = load(spark, d, "events")
    return ev.withColumn("arrival", disordered_arrival(ev))


@query(
    "late_record_split",
    f"WITH {WM_CTE} SELECT event_id, CASE WHEN wm IS NOT NULL AND ts < wm THEN 'late' ELSE 'main' END AS tag FROM x",
)
def late_record_split(spark, d):
    """Rows below the watermark of their micro-batch go to the late output."""
    return split_late_records(_arrived(spark, d), "ts", "arrival", "1 hour").select("event_id", "tag")


@query(
    "late_window_split",
    f"""WITH {WM_CTE}
SELECT event_id, CASE WHEN wm IS NOT NULL AND {tumble_end('ts', '1 hour')} <= wm THEN 'late' ELSE 'main' END AS tag
FROM x""",
)
def late_window_split(spark, d):
    """Rows whose 1 h window had closed: the rows a windowed aggregation would
    drop, kept as a side output."""
    return split_late_windows(_arrived(spark, d), "ts", "arrival", "1 hour", "1 hour").select("event_id", "tag")


@query(
    "allowed_lateness",
    f"""WITH {WM_CTE},
y AS (SELECT user_id, {tumble_end('ts', '1 hour')} AS window_end, wm FROM x)
SELECT user_id, window_end,
       count(*) FILTER (WHERE wm IS NULL OR window_end > wm) AS n_on_time,
       count(*) FILTER (WHERE wm IS NOT NULL AND window_end <= wm AND window_end + INTERVAL 1 HOUR > wm) AS n_late_kept,
       count(*) FILTER (WHERE wm IS NOT NULL AND window_end + INTERVAL 1 HOUR <= wm) AS n_dropped
FROM y GROUP BY user_id, window_end""",
)
def allowed_lateness(spark, d):
    """Per (user, 1 h window): on time, late within 1 h of allowed lateness
    (re-fires the window), dropped."""
    return lateness_classes(_arrived(spark, d), "user_id", "ts", "arrival", "1 hour", "1 hour", "1 hour")


@query(
    "early_fire_counts",
    f"""
WITH e AS (SELECT user_id, ts, {tumble_end('ts', '1 hour')} AS window_end, {tumble_end('ts', '10 minutes')} AS fire_ts FROM events),
f AS (SELECT DISTINCT user_id, window_end, fire_ts FROM e UNION SELECT DISTINCT user_id, window_end, window_end FROM e)
SELECT f.user_id, f.window_end, f.fire_ts, count(*) AS n
FROM f JOIN e ON e.user_id IS NOT DISTINCT FROM f.user_id AND e.window_end = f.window_end AND e.ts < f.fire_ts
GROUP BY ALL
""",
)
def early_fire_counts_q(spark, d):
    """1 h windows that fire early every 10 minutes of event time (with data)
    and at the end; each firing emits the running count."""
    return early_fire_counts(load(spark, d, "events"), "user_id", "ts", "1 hour", "10 minutes")


@query(
    "lateness_firings",
    f"""WITH {WM_CTE},
nx AS (SELECT batch, max(mx) OVER (ORDER BY batch) AS after FROM b),
y AS (SELECT user_id, {tumble_end('ts', '1 hour')} AS window_end, batch, wm FROM x),
c AS (SELECT window_end, (SELECT min(batch) FROM nx WHERE after >= window_end) AS closed_in FROM (SELECT DISTINCT window_end FROM y)),
f AS (SELECT user_id, window_end, CASE WHEN closed_in IS NOT NULL THEN greatest(batch, closed_in) END AS fired_in, count(*) AS c
      FROM y JOIN c USING (window_end) WHERE wm IS NULL OR window_end + INTERVAL 1 HOUR > wm GROUP BY ALL)
SELECT user_id, window_end, fired_in,
       CAST(sum(c) OVER (PARTITION BY user_id, window_end ORDER BY fired_in NULLS LAST) AS BIGINT) AS n,
       CASE WHEN row_number() OVER (PARTITION BY user_id, window_end ORDER BY fired_in NULLS LAST) = 1 THEN 'first' ELSE 'update' END AS kind
FROM f""",
)
def lateness_firings_q(spark, d):
    """Every firing of the 1 h windows with 1 h of allowed lateness: the first
    result and the updates by late rows, with the count so far."""
    return lateness_firings(_arrived(spark, d), "user_id", "ts", "arrival", "1 hour", "1 hour", "1 hour")


@query(
    "early_fire_grid",
    f"""
WITH e AS (SELECT user_id, ts, time_bucket(INTERVAL '10 minutes', ts) AS step, {tumble_end('ts', '1 hour')} AS window_end FROM events),
w AS (SELECT user_id, window_end, min(step) AS first FROM e GROUP BY ALL),
p AS (SELECT DISTINCT step AS fire_ts FROM e),
f AS (SELECT user_id, window_end, fire_ts FROM w JOIN p ON fire_ts > first AND fire_ts < window_end
      UNION ALL SELECT user_id, window_end, window_end FROM w)
SELECT f.user_id, f.window_end, f.fire_ts, count(*) AS n
FROM f JOIN e ON e.user_id IS NOT DISTINCT FROM f.user_id AND e.window_end = f.window_end AND e.ts < f.fire_ts
GROUP BY ALL
""",
)
def early_fire_grid(spark, d):
    """1 h windows that fire whenever the watermark enters a further step of 10
    minutes, with or without rows of their own, and at their end."""
    return firing_grid(load(spark, d, "events"), "user_id", "ts", "1 hour", "10 minutes")
