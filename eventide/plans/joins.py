"""Two-stream queries: reconciliation, unmatched sides, timeouts, gated
forwarding, multi-way left join count, and the co-group UDF form."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from eventide.functions.udfs import cogroup_process
from eventide.operators.joins import gated_forward, gated_forward_until, left_join_salted, reconcile, self_left_join_count, timed_out
from eventide.plans.registry import BEHAVIOR_CTE, query
from eventide.sources.tables import behavior_view, load, order_events, pay_events, receipts

# Order stream: all orders; receipt stream: the first shipment of each order.
# A receipt is due within 30 days of its order: a later one leaves both sides
# unmatched.
DUE = "30 days"
RECON_CTE = """
p AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS pay_ts FROM lineitem GROUP BY l_orderkey),
a AS (SELECT coalesce(o.o_orderkey, p.order_id) AS order_id, o.o_orderdate AS order_ts, p.pay_ts
      FROM orders o FULL OUTER JOIN p ON o.o_orderkey = p.order_id),
j AS (SELECT order_id, order_ts, pay_ts FROM a WHERE pay_ts <= order_ts + INTERVAL 30 DAY
      UNION ALL SELECT order_id, order_ts, NULL FROM a WHERE order_ts IS NOT NULL AND (pay_ts <= order_ts + INTERVAL 30 DAY) IS NOT TRUE
      UNION ALL SELECT order_id, NULL, pay_ts FROM a WHERE pay_ts IS NOT NULL AND (pay_ts <= order_ts + INTERVAL 30 DAY) IS NOT TRUE)
"""


def _recon(spark, d):
    o = order_events(load(spark, d, "orders")).withColumnRenamed("ts", "order_ts")
    return reconcile(o, receipts(load(spark, d, "lineitem")), "order_id", "order_ts", "pay_ts", bound=DUE)


@query(
    "order_reconcile",
    f"""
WITH {RECON_CTE}
SELECT CASE WHEN order_ts IS NOT NULL AND pay_ts IS NOT NULL THEN 'matched'
            WHEN pay_ts IS NULL THEN 'left_only' ELSE 'right_only' END AS tag,
       order_id, order_ts, pay_ts
FROM j
""",
)
def order_reconcile(spark, d):
    """Matched pairs plus both kinds of leftovers, tagged."""
    return _recon(spark, d).select("tag", "order_id", "order_ts", "pay_ts")


@query("order_unmatched", f"WITH {RECON_CTE} SELECT order_id, order_ts FROM j WHERE pay_ts IS NULL")
def order_unmatched(spark, d):
    """Side output: orders with no receipt."""
    return _recon(spark, d).where(F.col("tag") == "left_only").select("order_id", "order_ts")


@query("pay_unmatched", f"WITH {RECON_CTE} SELECT order_id, pay_ts FROM j WHERE order_ts IS NULL")
def pay_unmatched(spark, d):
    """Side output: receipts with no order."""
    return _recon(spark, d).where(F.col("tag") == "right_only").select("order_id", "pay_ts")


@query(
    "cogroup_pandas",
    f"""
WITH {RECON_CTE}
SELECT CASE WHEN order_ts IS NOT NULL AND pay_ts IS NOT NULL THEN 'matched'
            WHEN pay_ts IS NULL THEN 'left_only' ELSE 'right_only' END AS tag,
       order_id, order_ts, pay_ts
FROM j
""",
)
def cogroup_pandas(spark, d):
    """Co-process function over two keyed inputs (``cogroup().applyInPandas``):
    per key, one pending order and one pending receipt, matched or reported."""
    o = order_events(load(spark, d, "orders")).withColumnRenamed("ts", "order_ts")
    p = receipts(load(spark, d, "lineitem"))  # one row per key before the co-group

    def co(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        both = left.merge(right, on="order_id", how="outer")
        paid = both["pay_ts"] <= both["order_ts"] + pd.Timedelta(DUE)
        parts = [
            both[paid].assign(tag="matched"),
            both[~paid & both["order_ts"].notna()].assign(tag="left_only", pay_ts=pd.NaT),
            both[~paid & both["pay_ts"].notna()].assign(tag="right_only", order_ts=pd.NaT),
        ]
        return pd.concat(parts)[["tag", "order_id", "order_ts", "pay_ts"]]

    schema = "tag string, order_id long, order_ts timestamp_ntz, pay_ts timestamp_ntz"
    return cogroup_process(o, p, "order_id", co, schema)


@query(
    "order_timeout",
    """
SELECT o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                  AND l.l_shipdate <= o.o_orderdate + INTERVAL 30 DAY)
""",
)
def order_timeout(spark, d):
    """Orders with no payment (shipment) up to 30 days after creation,
    inclusive; a payment before the creation counts (the timer form)."""
    creates = order_events(load(spark, d, "orders"))
    pays = pay_events(load(spark, d, "lineitem"))
    return timed_out(creates, pays, "order_id", "ts", "ts", "30 days").select(F.col("order_id").alias("o_orderkey"))


@query(
    "gated_forward",
    """
SELECT r.event_id FROM events r
WHERE EXISTS (SELECT 1 FROM events g WHERE g.event_type = 'signup' AND g.user_id = r.user_id
              AND r.ts >= g.ts AND r.ts < g.ts + INTERVAL 1 DAY)
""",
)
def gated_forward_q(spark, d):
    """Readings pass while a gate (signup) of their key is open for 1 day."""
    ev = load(spark, d, "events")
    gates = ev.where(F.col("event_type") == "signup").select("user_id", "ts")
    return gated_forward(ev.select("event_id", "user_id", "ts"), gates, "user_id", "ts", "1 day").select("event_id")


@query(
    "gated_forward_durations",
    """
SELECT r.event_id FROM events r
WHERE EXISTS (SELECT 1 FROM events g WHERE g.event_type = 'signup' AND g.user_id = r.user_id
              AND r.ts >= g.ts AND r.ts < g.ts + to_minutes(CAST(floor(g.value * 60) AS BIGINT)))
""",
)
def gated_forward_durations(spark, d):
    """Readings pass while a gate of their key is open; every gate (signup)
    carries its own duration: its ``value`` in hours, to the minute."""
    ev = load(spark, d, "events")
    minutes = F.floor(F.col("value") * 60).cast("int")
    gates = ev.where(F.col("event_type") == "signup").select(
        "user_id", "ts", (F.col("ts") + F.make_dt_interval(mins=minutes)).alias("until"))
    return gated_forward_until(ev.select("event_id", "user_id", "ts"), gates, "user_id", "ts", "until").select("event_id")


@query(
    "left_join_3way_count",
    f"""
WITH {BEHAVIOR_CTE}
SELECT a.item_id, b.behavior, CAST(count(a.item_id) AS VARCHAR) AS cnt
FROM behavior a
LEFT JOIN behavior b ON a.item_id = b.item_id AND a.behavior = b.behavior
LEFT JOIN behavior c ON a.item_id = c.item_id AND a.behavior = c.behavior
GROUP BY a.item_id, b.behavior
""",
)
def left_join_3way_count(spark, d):
    """Three-way self left join + count, by per-key counts (m**3) instead of
    materialised joined rows; the count as text, exact at any size."""
    beh = behavior_view(load(spark, d, "events"))
    counts = self_left_join_count(beh, "item_id", "behavior", ways=3, name="cnt")
    return counts.withColumn("cnt", F.col("cnt").cast("string"))


@query(
    "left_join_two_keys",
    """
SELECT e.event_id, coalesce(s.event_id, -1) AS signup_id
FROM events e LEFT JOIN events s
  ON s.event_type = 'signup' AND s.user_id = e.user_id AND CAST(s.ts AS DATE) = CAST(e.ts AS DATE)
""",
)
def left_join_two_keys(spark, d):
    """Every event with the signups of its user on its day, or -1 where there is
    none: a left outer join on two keys."""
    ev = load(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type")
    signups = ev.where(F.col("event_type") == "signup").select("user_id", "day", F.col("event_id").alias("signup_id"))
    return left_join_salted(ev.drop("event_type"), signups, ["user_id", "day"]).select("event_id", F.coalesce("signup_id", F.lit(-1)).alias("signup_id"))
