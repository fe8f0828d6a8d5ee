"""Per-key ordered queries: rolling aggregates, jump and run detectors,
sequence matching, timer rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.functions.alerts import alert_text
from eventide.operators.keyed import keyed_positions, keyed_prefix, keyed_prefixes
from eventide.operators.sequences import (
    followed_within,
    login_failures,
    rising_runs,
    strict_sequence,
    value_jumps,
)
from eventide.operators.windows import tumbling
from eventide.plans.registry import query, tumble_end
from eventide.sources.tables import load, login_view, sensor_view

ORDER = ["ts", "event_id"]
W_ORDER = "PARTITION BY user_id ORDER BY ts, event_id"


def _events(spark, d):
    return load(spark, d, "events")


# -- rolling aggregates -----------------------------------------------------------

@query(
    "rolling_sum",
    f"""
SELECT user_id, event_id,
       first_value(event_type) OVER ({W_ORDER} ROWS UNBOUNDED PRECEDING) AS event_type,
       round(sum(value) OVER ({W_ORDER} ROWS UNBOUNDED PRECEDING), 6) AS value
FROM events
""",
)
def rolling_sum(spark, d):
    """``keyBy(user).sum(value)``: one row per input with the running sum;
    the other field keeps the key's first row value.  The sum is one of
    doubles; the result alone is rounded, as its last bits depend on order."""
    ev = _events(spark, d)
    # the key's first row is the running minimum of (ts, event_id, ...)
    first = F.struct("ts", "event_id", "event_type")
    run = keyed_prefixes(
        ev, "user_id", ORDER, [(F.col("value"), "_rs", "sum"), (first, "_first", "min")]
    )
    return run.select(
        "user_id", "event_id", F.col("_first.event_type").alias("event_type"), F.round("_rs", 6).alias("value")
    )


@query(
    "rolling_min_by",
    f"""
SELECT user_id, event_id, m.v AS min_value, m.e AS min_event_id FROM (
  SELECT user_id, event_id,
         min({{'v': value, 't': ts, 'e': event_id}}) OVER ({W_ORDER} ROWS UNBOUNDED PRECEDING) AS m
  FROM events)
""",
)
def rolling_min_by(spark, d):
    """``minBy(value)``: the whole row holding the running minimum (earliest
    on ties)."""
    ev = _events(spark, d)
    s = F.struct(F.col("value").alias("v"), F.col("ts").alias("t"), F.col("event_id").alias("e"))
    run = keyed_prefix(ev, "user_id", ORDER, s, "_m", agg="min")
    return run.select("user_id", "event_id", F.col("_m.v").alias("min_value"), F.col("_m.e").alias("min_event_id"))


@query(
    "rolling_list_concat",
    f"""
SELECT user_id, event_id, row_number() OVER ({W_ORDER}) AS pos, event_type FROM events
""",
)
def rolling_list_concat(spark, d):
    """Rolling list concatenation per key, without bound, in row form: the
    list at a row is the event types of the key's rows with the same or a
    smaller ``pos``.  Linear where one list a row would be quadratic."""
    return keyed_positions(_events(spark, d), "user_id", ORDER, "pos").select("user_id", "event_id", "pos", "event_type")


@query(
    "rolling_sum_of_window_min",
    f"""
SELECT user_id, window_end,
       round(sum(m) OVER (PARTITION BY user_id ORDER BY window_end ROWS UNBOUNDED PRECEDING), 6) AS s
FROM (SELECT user_id, {tumble_end('ts', '1 hour')} AS window_end, min(value) AS m FROM events GROUP BY ALL)
""",
)
def rolling_sum_of_window_min(spark, d):
    mins = tumbling(sensor_view(_events(spark, d)), "ts", "1 hour", ["user_id"], m=F.min("temperature"))
    run = keyed_prefix(mins, "user_id", ["window_end"], F.col("m"), "_s")
    return run.select("user_id", "window_end", F.round("_s", 6).alias("s"))


@query(
    "reduce_max_ts_min_temp",
    "SELECT user_id, max(ts) AS ts, min(value) AS temp FROM events GROUP BY user_id",
)
def reduce_max_ts_min_temp(spark, d):
    """Reduce function (max time, min temperature) per key."""
    return sensor_view(_events(spark, d)).groupBy("user_id").agg(
        F.max("ts").alias("ts"), F.min("temperature").alias("temp")
    )


@query(
    "running_count",
    "SELECT event_id, row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) AS n FROM events",
)
def running_count(spark, d):
    """Running record counter per bucket of 1000 ids (no global sort)."""
    w = Window.partitionBy(F.expr("event_id div 1000")).orderBy("event_id")
    return _events(spark, d).select("event_id", F.row_number().over(w).cast("bigint").alias("n"))


# -- jumps ----------------------------------------------------------------------------

def _lag_sql(default: str | None, flag_all: bool) -> str:
    prev = "lag(value) OVER (%s)" % W_ORDER if default is None else f"lag(value, 1, {default}) OVER ({W_ORDER})"
    if flag_all:
        return f"""
SELECT user_id, ts, event_id,
       CASE WHEN abs(value - prev) > 50 THEN prev ELSE 0.0 END AS last,
       CASE WHEN abs(value - prev) > 50 THEN value ELSE 0.0 END AS cur
FROM (SELECT user_id, ts, event_id, value, {prev} AS prev FROM events)
"""
    return f"""
SELECT user_id, ts, event_id, prev AS last, value AS cur
FROM (SELECT user_id, ts, event_id, value, {prev} AS prev FROM events)
WHERE abs(value - prev) > 50
"""


@query("temp_jump", _lag_sql(None, False))
def temp_jump(spark, d):
    """Alert when |temperature - previous| > 50; nothing on a first reading."""
    return value_jumps(sensor_view(_events(spark, d)), "user_id", "temperature", 50.0)


@query("temp_jump_default0", _lag_sql("0.0", False))
def temp_jump_default0(spark, d):
    """Same, with 0.0 standing for the missing previous reading."""
    return value_jumps(sensor_view(_events(spark, d)), "user_id", "temperature", 50.0, default_prev=0.0)


@query("temp_jump_flagged", _lag_sql("0.0", True))
def temp_jump_flagged(spark, d):
    """Rich-map form: one row per reading, (0.0, 0.0) when nothing fired."""
    return value_jumps(sensor_view(_events(spark, d)), "user_id", "temperature", 50.0, default_prev=0.0, flag_all=True)


@query(
    "rising_run_alert",
    f"""
WITH RECURSIVE s AS (
  SELECT user_id, ts, event_id, value, lag(value) OVER ({W_ORDER}) AS prev FROM events),
r AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR value < prev THEN 1 ELSE 0 END)
              OVER ({W_ORDER} ROWS UNBOUNDED PRECEDING) AS run,
         (prev IS NOT NULL AND value > prev) AS rise
  FROM s),
st AS (SELECT user_id, run, min(ts) AS start FROM r WHERE NOT rise AND (prev IS NULL OR value < prev) GROUP BY ALL),
ri AS (SELECT user_id, run, list(ts ORDER BY ts) AS rises FROM r WHERE rise GROUP BY ALL),
c AS (
  SELECT user_id, run, rises, rises[1] AS armed FROM ri
  UNION ALL
  SELECT user_id, run, rises, list_filter(rises, lambda x: x > armed + INTERVAL 6 HOUR)[1]
  FROM c WHERE list_filter(rises, lambda x: x > armed + INTERVAL 6 HOUR)[1] IS NOT NULL)
SELECT c.user_id, c.armed
FROM c LEFT JOIN st ON c.user_id IS NOT DISTINCT FROM st.user_id AND st.run = c.run + 1
WHERE st.start IS NULL OR st.start > c.armed + INTERVAL 6 HOUR
""",
)
def rising_run_alert(spark, d):
    """No fall for 6 hours after the rise that armed the timer."""
    return rising_runs(sensor_view(_events(spark, d)), "user_id", "temperature", "6 hours")


# -- sequences and timers -----------------------------------------------------------------

LOGIN_FAIL_SQL = f"""
WITH l AS (
  SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS t
  FROM events WHERE event_type IN ('error', 'signup')),
s AS (
  SELECT *, sum(CASE WHEN t = 'success' THEN 1 ELSE 0 END) OVER ({W_ORDER} ROWS UNBOUNDED PRECEDING) AS seg FROM l),
f AS (SELECT user_id, seg, min(ts) AS t0 FROM s WHERE t = 'fail' GROUP BY user_id, seg),
c AS (
  SELECT f.user_id, f.seg, f.t0, count(*) AS n
  FROM f JOIN s ON s.user_id IS NOT DISTINCT FROM f.user_id AND s.seg = f.seg AND s.t = 'fail' AND s.ts <= f.t0 + INTERVAL 7 DAY
  GROUP BY ALL),
nx AS (SELECT user_id, seg - 1 AS seg, ts AS nts FROM s WHERE t = 'success')
SELECT c.user_id, c.t0 AS first_fail, c.n AS fails
FROM c LEFT JOIN nx ON c.user_id IS NOT DISTINCT FROM nx.user_id AND c.seg = nx.seg
WHERE c.n > 2 AND (nx.nts IS NULL OR nx.nts > c.t0 + INTERVAL 7 DAY)
"""


@query("login_fail_timer", LOGIN_FAIL_SQL)
def login_fail_timer(spark, d):
    """More than two fails within 7 days of the first fail of a segment."""
    return login_failures(login_view(_events(spark, d)), "user_id", "7 days", 2)


SEQ3_SQL = f"""
SELECT user_id, event_id AS event_id_1, e2 AS event_id_2, e3 AS event_id_3, ts AS first_ts, t3 AS last_ts
FROM (SELECT user_id, event_id, ts, event_type,
             lead(event_type, 1) OVER ({W_ORDER}) AS y2, lead(event_type, 2) OVER ({W_ORDER}) AS y3,
             lead(event_id, 1) OVER ({W_ORDER}) AS e2, lead(event_id, 2) OVER ({W_ORDER}) AS e3,
             lead(ts, 2) OVER ({W_ORDER}) AS t3
      FROM events)
WHERE event_type = 'error' AND y2 = 'error' AND y3 = 'error' AND t3 < ts + INTERVAL 7 DAY
"""


@query("seq3_fail", SEQ3_SQL)
def seq3_fail(spark, d):
    """Three consecutive fails (strict contiguity) within 7 days."""
    return strict_sequence(_events(spark, d), "user_id", "event_type", ["error"] * 3, "7 days")


@query(
    "seq3_fail_text",
    f"""
WITH l AS (
  SELECT user_id, ts, event_id, '10.0.0.' || CAST(json_extract_string(props, '$.k') AS BIGINT) AS ip,
         CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS t
  FROM events WHERE event_type IN ('error', 'signup')),
s AS (SELECT *, lead(t, 1) OVER ({W_ORDER}) AS t2, lead(t, 2) OVER ({W_ORDER}) AS t3, lead(ip, 1) OVER ({W_ORDER}) AS ip2,
             lead(ip, 2) OVER ({W_ORDER}) AS ip3, lead(ts, 2) OVER ({W_ORDER}) AS ts3 FROM l)
SELECT user_id, 'user ' || coalesce(CAST(user_id AS VARCHAR), 'null') || ' failed to log in three times in a row, from '
       || coalesce(ip, 'null') || '; ' || coalesce(ip2, 'null') || '; ' || coalesce(ip3, 'null') AS message
FROM s WHERE t = 'fail' AND t2 = 'fail' AND t3 = 'fail' AND ts3 < ts + INTERVAL 7 DAY
""",
)
def seq3_fail_text(spark, d):
    """Three consecutive login failures, each step a predicate of its own, as
    alert texts with the addresses."""
    logins = login_view(_events(spark, d))
    fail = F.col("event_type") == "fail"
    steps = [fail, F.col("event_type") != "success", F.col("event_type").startswith("f")]
    found = strict_sequence(logins, "user_id", None, steps, "7 days", carry=["ip"])
    text = alert_text("user {user_id} failed to log in three times in a row, from {ip_1}; {ip_2}; {ip_3}")
    return found.select("user_id", text.alias("message"))


@query(
    "login_fail_text",
    f"""SELECT 'user ' || coalesce(CAST(user_id AS VARCHAR), 'null') || ': ' || fails || ' failed logins since '
        || strftime(first_fail, '%Y-%m-%d %H:%M:%S') AS message FROM ({LOGIN_FAIL_SQL})""",
)
def login_fail_text(spark, d):
    """The login-failure alerts as texts."""
    text = alert_text("user {user_id}: {fails} failed logins since {since}", since=F.date_format("first_fail", "yyyy-MM-dd HH:mm:ss"))
    return login_failures(login_view(_events(spark, d)), "user_id", "7 days", 2).select(text.alias("message"))


_SEQ2 = f"""
WITH s AS (
  SELECT user_id, event_id, ts, event_type,
         lead(event_type) OVER ({W_ORDER}) AS nt, lead(ts) OVER ({W_ORDER}) AS nts,
         lead(event_id) OVER ({W_ORDER}) AS ne
  FROM events)
"""


@query(
    "seq2_matched",
    _SEQ2
    + """
SELECT user_id, event_id, ne AS next_event_id FROM s
WHERE event_type = 'view' AND nt = 'purchase' AND nts < ts + INTERVAL 1 DAY
""",
)
def seq2_matched(spark, d):
    """view -> next purchase within 1 day."""
    m = followed_within(_events(spark, d), "user_id", "event_type", "view", "purchase", "1 day")
    return m.where(F.col("outcome") == "matched").select("user_id", "event_id", "next_event_id")


@query(
    "seq2_timeout",
    _SEQ2
    + """
SELECT user_id, event_id, ts FROM s
WHERE event_type = 'view' AND (nts IS NULL OR nts >= ts + INTERVAL 1 DAY)
""",
)
def seq2_timeout(spark, d):
    """view whose partial match times out (side output of the pattern)."""
    m = followed_within(_events(spark, d), "user_id", "event_type", "view", "purchase", "1 day")
    return m.where(F.col("outcome") == "timeout").select("user_id", "event_id", "ts")
