"""Structured Streaming queries.  Each runs a checkpointed stream with
``availableNow`` over the given tables (or staged time slices of them),
writes to a file sink under the shared checkpoint folder and returns the
sink read back as a DataFrame.

The inputs are bounded: after the last row each is closed by a final watermark
(``streaming.sources.watermarked``), so windows, timers and unmatched join rows
still open then are emitted too and the results are those of the batch forms.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eventide.operators.late import disordered_arrival
from eventide.operators.ranking import top_n_per_group
from eventide.plans.keyed import LOGIN_FAIL_SQL, SEQ3_SQL
from eventide.plans.registry import ARRIVAL, BEHAVIOR_CTE, query, slide_ends, tumble_end
from eventide.plans.windows import HOT_ITEMS_SQL, HOT_ITEMS_SQL5, hot_items_df, top_items_sql
from eventide.sources.tables import behavior_view, load, login_view, marketing_view, page_views, sensor_view
from eventide.streaming.sinks import (
    read_json_docs,
    read_upserted,
    run_available,
    state_on_disk,
    upsert_windows,
    write_json_docs,
)
from eventide.streaming.sources import (
    dir_stream,
    new_stream_dirs,
    run_in_slices,
    run_to_the_end,
    stage_slices,
    table_stream,
    time_quantiles,
    to_event_time,
    watermarked,
)
from eventide.streaming.carry import counter_writer, last_state, list_texts, sequence_writer, state_kinds_writer, state_list
from eventide.streaming.changelog import VersionedTable, top_n_writer
from eventide.streaming.late import close_firing_log, firing_log_writer, late_split_writer, run_per_slice
from eventide.streaming.range_join import SMALL_TASKS, Side, range_join_writer, side_by_side
from eventide.streaming.state import (
    jump_alerts,
    login_fail_alerts,
    two_step_with_timeout,
)

DELAY = "10 minutes"


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


@query("stream_file_source", "SELECT event_id, event_type FROM events")
def stream_file_source(spark, d):
    """File stream over the events table into a Parquet sink."""
    dirs = new_stream_dirs(spark, "file-source")
    s = table_stream(spark, d, "events").select("event_id", "event_type")
    run_available(s.writeStream.format("parquet").option("path", dirs["output"]), dirs["checkpoint"])
    return spark.read.parquet(dirs["output"])


def _tumbling_stream(source, tails, base):
    ev = watermarked(to_event_time(source), "ts", DELAY, tails, base)
    agg = ev.groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(F.col("window.end").cast("timestamp_ntz").alias("window_end"), "n")


TUMBLING_SQL = f"""
SELECT window_end, count(*) AS n
FROM (SELECT {tumble_end('ts', '1 hour')} AS window_end FROM events)
GROUP BY window_end
"""


def _drain(spark, out, dirs, tails, mode="append", by_batch=None):
    """Write ``out`` to the output folder until all inputs are closed; with
    ``by_batch`` that function writes there, by batch id."""
    if by_batch is None:
        writer = out.writeStream.format("parquet").option("path", dirs["output"]).outputMode(mode)
    else:
        writer = out.writeStream.foreachBatch(by_batch)
    run_to_the_end(lambda: run_available(writer, dirs["checkpoint"]), spark, tails)
    return spark.read.parquet(dirs["output"]).drop(*([] if by_batch is None else ["batch_id"]))


DAY = dt.timedelta(days=1)


def _range_join(spark, dirs, tails, o, p, low, how, result):
    """Orders and their payments (distinct by order and time), due up to 30
    days after the order; both inputs have a watermark of 1 day."""
    left, right = Side(*o.columns, DAY), Side(*p.columns, DAY, unique=True)
    writer = range_join_writer(spark, f"{dirs['base']}/state", dirs["output"], left, right, low, 30 * DAY, how, result)
    with state_on_disk(spark, SMALL_TASKS):
        return _drain(spark, side_by_side(o, p), dirs, tails, by_batch=writer)


@query("stream_tumbling_closed", TUMBLING_SQL)
def stream_tumbling_closed(spark, d):
    """1 h counts in append mode with a 10 minute watermark delay: every
    window once, when the watermark closes it."""
    dirs, tails = new_stream_dirs(spark, "tumbling"), []
    out = _tumbling_stream(table_stream(spark, d, "events"), tails, dirs["base"])
    return _drain(spark, out, dirs, tails)


@query("stream_restart_resume", TUMBLING_SQL)
def stream_restart_resume(spark, d):
    """Exactly-once restart: run on the first half of the input, stop, add the
    second half, resume on the same checkpoint; equals one run."""
    dirs = new_stream_dirs(spark, "restart")
    ev = load(spark, d, "events")
    cut = time_quantiles(ev, "ts", 2) or [None]
    first = ev if cut[0] is None else ev.where(F.col("ts") < F.lit(cut[0]))
    stage_slices(first, dirs["input"], "ts", [], 0)
    src = dir_stream(spark, f"{dirs['input']}/slice-*", ev.schema, max_files=None)
    tails = []
    out = _tumbling_stream(src, tails, dirs["base"])
    run_available(out.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append"), dirs["checkpoint"])
    second = ev.where(F.lit(False)) if cut[0] is None else ev.where(F.col("ts") >= F.lit(cut[0]))
    stage_slices(second, dirs["input"], "ts", [], 1)
    # a query built anew on the same checkpoint
    src = dir_stream(spark, f"{dirs['input']}/slice-*", ev.schema, max_files=None)
    tails = []
    out = _tumbling_stream(src, tails, dirs["base"])
    return _drain(spark, out, dirs, tails)


@query(
    "stream_order_timeout",
    """
SELECT o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                  AND l.l_shipdate <= o.o_orderdate + INTERVAL 30 DAY)
""",
)
def stream_order_timeout(spark, d):
    """Order timeout as a left-outer time-range join of two streams: an order
    is reported once the watermark passes its payment deadline unmatched.  A
    payment of any time before the deadline counts, so payments stay in the
    state; they are deduplicated by (order, time) before the join."""
    dirs, tails = new_stream_dirs(spark, "order-timeout"), []
    o = to_event_time(table_stream(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("create_ts")), "create_ts")
    p = to_event_time(table_stream(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("pay_order"), F.col("l_shipdate").alias("pay_ts")), "pay_ts")
    o = watermarked(o, "create_ts", "1 day", tails, dirs["base"], closing_row=True)
    p = watermarked(p, "pay_ts", "1 day", tails, dirs["base"], closing_row=True)

    def unpaid(j):
        return j.where(F.col("pay_order").isNull()).select(F.col("order_id").alias("o_orderkey"))

    return _range_join(spark, dirs, tails, o, p, None, "left_outer", unpaid)


def _staged_events(spark, d, name, slices=4):
    """Events as a stream of ``slices`` event-time slices; returns the stream
    directories, the streaming source and a runner that stages and drains one
    slice per ``availableNow`` run (one micro-batch per slice), then closes
    the inputs given to it."""
    dirs = new_stream_dirs(spark, name)
    ev = load(spark, d, "events")
    bounds = time_quantiles(ev, "ts", slices)
    src = dir_stream(spark, f"{dirs['input']}/slice-*", ev.schema, max_files=None)

    def run(writer, tails=()):
        run_in_slices(ev, "ts", bounds, dirs["input"], lambda: run_available(writer, dirs["checkpoint"]))
        if tails:
            run_to_the_end(lambda: run_available(writer, dirs["checkpoint"]), spark, tails)

    return dirs, src, run


@query(
    "stream_temp_jump",
    """
SELECT user_id, ts, event_id, prev AS last, value AS cur
FROM (SELECT user_id, ts, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE abs(value - prev) > 50
""",
)
def stream_temp_jump(spark, d):
    """Jump alert with keyed value state across micro-batches (4 event-time
    slices, one per trigger)."""
    dirs, src, run_slices = _staged_events(spark, d, "temp-jump")
    alerts = jump_alerts(to_event_time(sensor_view(src)), 50.0)
    run_slices(alerts.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append"))
    return spark.read.parquet(dirs["output"]).select("user_id", _ntz("ts"), "event_id", "last", "cur")


STATE_CTE = """
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
ls AS (SELECT user_id, max(rn) AS srn FROM o WHERE event_type = 'signup' GROUP BY user_id),
seg AS (SELECT o.*, rn - coalesce(ls.srn, 1) + 1 AS pos FROM o LEFT JOIN ls ON ls.user_id IS NOT DISTINCT FROM o.user_id
        WHERE o.rn >= coalesce(ls.srn, 1))
"""


def _run_state_kinds(spark, d):
    dirs, src, run_slices = _staged_events(spark, d, "state-kinds")
    clear, item, value = F.col("event_type") == "signup", F.col("event_type"), F.col("value")
    writer = state_kinds_writer(dirs["output"], "user_id", clear, item, value)
    run_slices(to_event_time(src).writeStream.foreachBatch(writer))
    return dirs["output"]


@query(
    "stream_state_kinds",
    f"""
WITH {STATE_CTE},
agg AS (SELECT user_id, count(*) AS n, max(ts) AS max_ts, min(value) AS min_value FROM seg GROUP BY user_id),
tc AS (SELECT user_id, string_agg(event_type || ':' || c, ',' ORDER BY event_type) AS type_counts
       FROM (SELECT user_id, event_type, count(*) AS c FROM seg GROUP BY ALL) GROUP BY user_id),
l3 AS (SELECT user_id, string_agg(event_type, ',' ORDER BY pos) FILTER (k <= 3) AS last_types, string_agg(event_type, ',' ORDER BY pos) AS types
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos DESC) AS k FROM seg) GROUP BY user_id)
SELECT agg.user_id, n, last_types, types, type_counts, max_ts, min_value
FROM agg JOIN l3 ON agg.user_id IS NOT DISTINCT FROM l3.user_id JOIN tc ON agg.user_id IS NOT DISTINCT FROM tc.user_id
""",
)
def stream_state_kinds(spark, d):
    """Value, list, map and reducing state per user, cleared by signup, after
    the stream (4 event-time slices) has drained; the list (whole, and its last
    three entries) and the map's entries as text."""
    path = _run_state_kinds(spark, d)
    now, counts = last_state(spark, path, "values"), last_state(spark, path, "counts")
    entry = F.struct("item", F.concat_ws(":", "item", "c").alias("t"))
    texts = counts.groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("e")).select(F.col("user_id").alias("_u"), F.array_join("e.t", ",").alias("type_counts"))
    lists = list_texts(state_list(spark, path, "user_id"), "user_id", 3).withColumnRenamed("user_id", "_l")
    out = now.join(texts, now["user_id"].eqNullSafe(texts["_u"])).join(lists, now["user_id"].eqNullSafe(lists["_l"]))
    return out.select("user_id", "n", F.col("last").alias("last_types"), F.col("whole").alias("types"), "type_counts", _ntz("max_ts"), "min_value")


@query("stream_state_list", f"WITH {STATE_CTE} SELECT user_id, pos, event_id, event_type FROM seg")
def stream_state_list(spark, d):
    """List state per user, cleared by signup: all entries since then, as rows
    with their place in the list."""
    held = state_list(spark, _run_state_kinds(spark, d), "user_id")
    return held.select("user_id", "pos", "event_id", F.col("item").alias("event_type"))


@query("stream_counter", "SELECT count(*) AS n FROM events")
def stream_counter(spark, d):
    """Running counter in list state: each of the 4 slices is counted by a query
    started anew on the same checkpoint, which adds its tasks' numbers to the
    list that the others left."""
    dirs, src, run_slices = _staged_events(spark, d, "counter")
    run_slices(src.writeStream.foreachBatch(counter_writer(dirs["output"])))
    return spark.read.parquet(f"{dirs['output']}/counter").agg(F.sum("n").alias("n"))


@query(
    "stream_hot_items",
    f"""
WITH {BEHAVIOR_CTE},
c AS (
  SELECT window_end, item_id, count(*) AS cnt
  FROM (SELECT item_id, {slide_ends('ts', '60 minutes', '5 minutes')} AS window_end FROM behavior WHERE behavior = 'pv')
  GROUP BY window_end, item_id)
SELECT window_end, item_id, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM c)
WHERE rank <= 3
""",
)
def stream_hot_items(spark, d):
    """Hot items on a stream: sliding counts in append mode (each window
    emitted once, when closed), then per micro-batch a bounded top-3 per
    window (group-limited ranking, no list of all items)."""
    dirs, tails = new_stream_dirs(spark, "hot-items"), []
    pv = to_event_time(page_views(table_stream(spark, d, "events")))
    counts = (
        watermarked(pv, "ts", DELAY, tails, dirs["base"])
        .groupBy(F.window("ts", "1 hour", "5 minutes"), "item_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.col("window.end").cast("timestamp_ntz").alias("window_end"), "item_id", "cnt")
    )
    out = dirs["output"]

    def top3(batch, batch_id):
        # one directory per micro-batch, overwritten on replay: idempotent
        ranked = top_n_per_group(batch, ["window_end"], [F.desc("cnt"), F.asc("item_id")], 3)
        ranked.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = counts.writeStream.foreachBatch(top3).outputMode("append")
    run_to_the_end(lambda: run_available(writer, dirs["checkpoint"]), spark, tails)
    return spark.read.parquet(out).select("window_end", "item_id", "cnt", "rank")


@query("sink_upsert", HOT_ITEMS_SQL5)
def sink_upsert(spark, d):
    """Window upsert sink: a partial result (first half of the events), then
    the full result, then the full result again; the target ends equal to
    the full result (stale ranks replaced, re-runs idempotent)."""
    dirs = new_stream_dirs(spark, "upsert")
    target = dirs["output"]
    ev = load(spark, d, "events")
    cut = (time_quantiles(ev, "ts", 2) or [None])[0]
    first_half = ev if cut is None else ev.where(F.col("ts") < F.lit(cut))
    upsert_windows(top_items_sql(spark, first_half), target)
    full = top_items_sql(spark, ev)
    upsert_windows(full, target)
    upsert_windows(full, target)
    return read_upserted(spark, target).select("item_id", "cnt", "window_end", "row_num")


def _run_changelog(spark, d):
    """Top 5 items per hop window, kept by an update-mode stream over 4
    event-time slices."""
    dirs, src, run_slices = _staged_events(spark, d, "changelog")
    pv = to_event_time(page_views(src)).withWatermark("ts", DELAY)
    counts = (
        pv.groupBy(F.window("ts", "1 hour", "5 minutes"), "item_id")
        .agg(F.count("item_id").alias("cnt"))
        .select(F.col("window.end").cast("timestamp_ntz").alias("window_end"), "item_id", "cnt")
    )
    writer = top_n_writer(dirs["output"], ["window_end"], ["item_id"], [F.desc("cnt"), F.asc("item_id")], 5, "row_num")
    run_slices(counts.writeStream.outputMode("update").foreachBatch(writer))
    return VersionedTable(spark, f"{dirs['output']}/top", ["window_end"])


@query("stream_upsert_top5", HOT_ITEMS_SQL5)
def stream_upsert_top5(spark, d):
    """The SQL top 5 as a table that an updating stream keeps: rows that leave
    a window's top 5 leave the table."""
    return _run_changelog(spark, d).read().select("item_id", "cnt", "window_end", "row_num")


@query("stream_changelog_top5", HOT_ITEMS_SQL5)
def stream_changelog_top5(spark, d):
    """The same table from its changelog: the rows whose additions outnumber
    their removals."""
    names = ["item_id", "cnt", "window_end", "row_num"]
    return _run_changelog(spark, d).changes().groupBy(*names).agg(F.sum("sign").alias("_s")).where("_s > 0").select(*names)


@query("stream_json_docs", HOT_ITEMS_SQL)
def stream_json_docs(spark, d):
    """JSON documents written by a stream: each micro-batch puts the top 3 of
    the windows it closes into a folder of its own."""
    dirs, tails = new_stream_dirs(spark, "stream-json-docs"), []
    pv = to_event_time(page_views(table_stream(spark, d, "events")))
    counts = (
        watermarked(pv, "ts", DELAY, tails, dirs["base"])
        .groupBy(F.window("ts", "1 hour", "5 minutes"), "item_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.col("window.end").cast("timestamp_ntz").alias("window_end"), "item_id", "cnt")
    )

    def write(batch, batch_id):
        top = top_n_per_group(batch, ["window_end"], [F.desc("cnt"), F.asc("item_id")], 3)
        write_json_docs(top, dirs["output"], "slidingwindow", batch_id)

    writer = counts.writeStream.foreachBatch(write).outputMode("append")
    run_to_the_end(lambda: run_available(writer, dirs["checkpoint"]), spark, tails)
    return read_json_docs(
        spark, dirs["output"], "window_end timestamp_ntz, item_id bigint, cnt bigint, rank bigint", field="slidingwindow"
    )


@query("sink_json_docs", HOT_ITEMS_SQL)
def sink_json_docs(spark, d):
    """Search-index style sink: one JSON document per result row, written in
    bulk, read back."""
    dirs = new_stream_dirs(spark, "json-docs")
    write_json_docs(hot_items_df(spark, d, 3), dirs["output"], field="slidingwindow")
    return read_json_docs(
        spark, dirs["output"], "window_end timestamp_ntz, item_id bigint, cnt bigint, rank bigint", field="slidingwindow"
    )


# -- late data on streams: micro-batch = 3-day arrival slice ------------------

TRIGGER_DAYS = 3
LONGEST = dt.timedelta(hours=3)  # of an arrival after its event
STREAM_LATE_CTE = f"""
a AS (SELECT *, {ARRIVAL} AS arrival,
             time_bucket(INTERVAL '{TRIGGER_DAYS} days', {ARRIVAL}, TIMESTAMP '1970-01-01') AS batch FROM events),
b AS (SELECT batch, max(ts) AS mx FROM a GROUP BY batch),
w AS (SELECT batch, max(mx) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm FROM b),
x AS (SELECT a.*, w.wm FROM a JOIN w USING (batch))
"""


def _arrivals(spark, d):
    ev = load(spark, d, "events")
    return ev.withColumn("arrival", disordered_arrival(ev)).select("event_id", "user_id", "ts", "arrival")


@query(
    "stream_late_split",
    f"WITH {STREAM_LATE_CTE} SELECT event_id, CASE WHEN wm IS NOT NULL AND ts < wm THEN 'late' ELSE 'main' END AS tag FROM x",
)
def stream_late_split(spark, d):
    """Late rows as a side output of a stream: rows arrive in 3-day arrival
    micro-batches; a row behind the watermark of the earlier batches is
    tagged late instead of being dropped."""
    dirs = new_stream_dirs(spark, "late-split")
    ev = _arrivals(spark, d)
    out, state = dirs["output"], f"{dirs['base']}/batch-max"
    src = dir_stream(spark, f"{dirs['input']}/slice-*", ev.schema, max_files=None)
    writer = src.writeStream.foreachBatch(late_split_writer(state, out))
    run_per_slice(ev, "arrival", TRIGGER_DAYS, dirs["input"], lambda: run_available(writer, dirs["checkpoint"]), "ts", LONGEST)
    return spark.read.parquet(out).select("event_id", "tag")


@query(
    "stream_allowed_lateness",
    f"""WITH {STREAM_LATE_CTE},
y AS (SELECT user_id, {tumble_end('ts', '1 hour')} AS window_end, wm FROM x)
SELECT user_id, window_end, count(*) AS n FROM y
WHERE wm IS NULL OR window_end > wm - INTERVAL 1 HOUR
GROUP BY user_id, window_end""",
)
def stream_allowed_lateness(spark, d):
    """1 h windows with 1 h of allowed lateness on a stream: update mode with
    the watermark delayed by the lateness, so late rows re-fire their window
    until it is 1 h past its end; later rows are dropped.  The sink keeps the
    last firing per window."""
    dirs = new_stream_dirs(spark, "allowed-lateness")
    ev = _arrivals(spark, d)
    out = dirs["output"]
    src = to_event_time(dir_stream(spark, f"{dirs['input']}/slice-*", ev.schema, max_files=None))
    counts = (
        src.withWatermark("ts", "1 hour")
        .groupBy("user_id", F.window("ts", "1 hour"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("user_id", F.col("window.end").cast("timestamp_ntz").alias("window_end"), "n")
    )

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write)
    run_per_slice(ev, "arrival", TRIGGER_DAYS, dirs["input"], lambda: run_available(writer, dirs["checkpoint"]), "ts", LONGEST)
    fired = spark.read.parquet(out)
    return fired.groupBy("user_id", "window_end").agg(F.max_by("n", "batch_id").alias("n"))


@query(
    "stream_lateness_firings",
    f"""WITH {STREAM_LATE_CTE},
nx AS (SELECT batch, max(mx) OVER (ORDER BY batch) AS after FROM b),
y AS (SELECT user_id, {tumble_end('ts', '1 hour')} AS window_end, batch, wm FROM x),
c AS (SELECT window_end, (SELECT min(batch) FROM nx WHERE after >= window_end) AS closed_in FROM (SELECT DISTINCT window_end FROM y)),
f AS (SELECT user_id, window_end, CASE WHEN closed_in IS NOT NULL THEN greatest(batch, closed_in) END AS fired_in, count(*) AS c
      FROM y JOIN c USING (window_end) WHERE wm IS NULL OR window_end + INTERVAL 1 HOUR > wm GROUP BY ALL)
SELECT user_id, window_end, CAST(sum(c) OVER (PARTITION BY user_id, window_end ORDER BY fired_in NULLS LAST) AS BIGINT) AS n,
       CASE WHEN row_number() OVER (PARTITION BY user_id, window_end ORDER BY fired_in NULLS LAST) = 1 THEN 'first' ELSE 'update' END AS kind
FROM f""",
)
def stream_lateness_firings(spark, d):
    """Every firing of 1 h windows with 1 h of allowed lateness on a stream of
    3-day arrival micro-batches: first results and updates by late rows."""
    dirs = new_stream_dirs(spark, "lateness-firings")
    ev, out = _arrivals(spark, d), dirs["output"]
    src = dir_stream(spark, f"{dirs['input']}/slice-*", ev.schema, max_files=None)
    writer = src.writeStream.foreachBatch(firing_log_writer(out, "user_id", "1 hour", "1 hour"))
    run_per_slice(ev, "arrival", TRIGGER_DAYS, dirs["input"], lambda: run_available(writer, dirs["checkpoint"]), "ts", LONGEST)
    close_firing_log(spark, out, "user_id", "1 hour")
    return spark.read.parquet(f"{out}/firings").select("user_id", "window_end", "n", "kind")


@query(
    "stream_group_count",
    f"WITH {BEHAVIOR_CTE} SELECT item_id, behavior, count(item_id) AS cnt FROM behavior GROUP BY item_id, behavior",
)
def stream_group_count(spark, d):
    """SQL GROUP BY and count as an updating stream: each micro-batch replaces
    the counts it changes in a versioned table."""
    dirs, src, run_slices = _staged_events(spark, d, "group-count")
    counts = spark.sql(
        "SELECT item_id, behavior, count(item_id) AS cnt FROM {b} GROUP BY item_id, behavior", b=behavior_view(src)
    )
    group = ["item_id", "behavior"]

    def update(batch, batch_id):
        VersionedTable(batch.sparkSession, dirs["output"], group).replace(batch, batch.select(*group), batch_id)

    run_slices(counts.writeStream.outputMode("update").foreachBatch(update))
    return VersionedTable(spark, dirs["output"], group).read().select("item_id", "behavior", "cnt")


@query("stream_login_fail", LOGIN_FAIL_SQL)
def stream_login_fail(spark, d):
    """Login-failure timer on a stream (event-time timeouts in keyed state),
    over 4 event-time slices; the final watermark fires the timers left."""
    dirs, src, run_slices = _staged_events(spark, d, "login-fail")
    tails = []
    logins = watermarked(to_event_time(login_view(src)), "ts", "0 seconds", tails, dirs["base"])
    alerts = login_fail_alerts(logins, 7 * 86400, 2)
    run_slices(alerts.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append"), tails)
    return spark.read.parquet(dirs["output"]).select("user_id", _ntz("first_fail"), "fails")


@query(
    "stream_uv_sliding",
    f"""
WITH {BEHAVIOR_CTE}
SELECT window_end, count(DISTINCT user_id) AS n
FROM (SELECT user_id, {slide_ends('ts', '60 minutes', '5 minutes')} AS window_end FROM behavior WHERE behavior = 'pv')
GROUP BY window_end
""",
)
def stream_uv_sliding(spark, d):
    """Unique visitors per 1 h / 5 min window on a stream: two chained
    aggregations in append mode (one row per window and user, then a count
    per window), each window emitted once when closed."""
    dirs, tails = new_stream_dirs(spark, "uv-sliding"), []
    pv = to_event_time(page_views(table_stream(spark, d, "events")))
    per_user = (
        watermarked(pv, "ts", DELAY, tails, dirs["base"])
        .groupBy(F.window("ts", "1 hour", "5 minutes").alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    uv = per_user.groupBy("w").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n"
    )
    return _drain(spark, uv, dirs, tails)


@query("stream_seq3_fail", SEQ3_SQL)
def stream_seq3_fail(spark, d):
    """Three consecutive errors within 7 days, matched on a stream of 4
    event-time slices (matches may span micro-batches)."""
    dirs, src, run_slices = _staged_events(spark, d, "seq3")
    fail = F.col("event_type") == "error"
    run_slices(to_event_time(src).writeStream.foreachBatch(sequence_writer(dirs["output"], "user_id", [fail] * 3, "7 days")))
    out = spark.read.parquet(f"{dirs['output']}/matches")
    return out.select("user_id", "event_id_1", "event_id_2", "event_id_3", _ntz("first_ts"), _ntz("last_ts"))


@query(
    "stream_seq2",
    """
WITH s AS (
  SELECT user_id, event_id, ts, event_type,
         lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nt,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts
  FROM events)
SELECT user_id, event_id, 'matched' AS outcome FROM s
WHERE event_type = 'view' AND nt = 'purchase' AND nts < ts + INTERVAL 1 DAY
UNION ALL
SELECT user_id, event_id, 'timeout' AS outcome FROM s
WHERE event_type = 'view' AND (nts IS NULL OR nts >= ts + INTERVAL 1 DAY)
""",
)
def stream_seq2(spark, d):
    """view -> next purchase within 1 day on a stream (4 event-time slices):
    matches, and timeouts either when a late next event arrives or when the
    watermark passes the deadline."""
    dirs, src, run_slices = _staged_events(spark, d, "seq2")
    tails = []
    ev = watermarked(to_event_time(src), "ts", "0 seconds", tails, dirs["base"])
    res = two_step_with_timeout(ev, "event_type", "view", "purchase", 86400)
    run_slices(res.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append"), tails)
    return spark.read.parquet(dirs["output"])


@query(
    "stream_gated_forward",
    """
SELECT r.event_id FROM events r
WHERE EXISTS (SELECT 1 FROM events g WHERE g.event_type = 'signup' AND g.user_id = r.user_id
              AND r.ts >= g.ts AND r.ts < g.ts + INTERVAL 1 DAY)
""",
)
def stream_gated_forward(spark, d):
    """Gated forwarding between two streams: readings pass while a gate of
    their key is open (1 day); a left-semi stream-stream join with a time
    range, so each reading passes once and gate state expires with the
    watermark."""
    dirs = new_stream_dirs(spark, "gated")
    rows = to_event_time(table_stream(spark, d, "events").select("event_id", "user_id", "ts")).withWatermark("ts", "1 hour")
    gates = (
        to_event_time(table_stream(spark, d, "events").where(F.col("event_type") == "signup").select(
            F.col("user_id").alias("g_user"), F.col("ts").alias("g_ts")), "g_ts")
        .withWatermark("g_ts", "1 hour")
    )
    cond = F.expr("user_id = g_user AND ts >= g_ts AND ts < g_ts + INTERVAL 1 DAY")
    passed = rows.join(gates, cond, "left_semi").select("event_id")
    run_available(passed.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append"), dirs["checkpoint"])
    return spark.read.parquet(dirs["output"])


@query(
    "stream_marketing_by_channel",
    f"""
SELECT window_end, channel, behavior, count(*) AS n
FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'AppStore' ELSE 'OtherStore' END AS channel,
             event_type AS behavior, {slide_ends('ts', '5 hours', '1 hour')} AS window_end
      FROM events WHERE event_type <> 'error')
GROUP BY window_end, channel, behavior
""",
)
def stream_marketing_by_channel(spark, d):
    """Marketing counts per (channel, behaviour) on a stream: sliding 5 h /
    1 h windows in append mode, each window emitted once when closed."""
    dirs, tails = new_stream_dirs(spark, "marketing"), []
    m = to_event_time(marketing_view(table_stream(spark, d, "events"))).where(F.col("behavior") != "error")
    counts = (
        watermarked(m, "ts", DELAY, tails, dirs["base"])
        .groupBy(F.window("ts", "5 hours", "1 hour"), "channel", "behavior")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.end").cast("timestamp_ntz").alias("window_end"), "channel", "behavior", "n")
    )
    return _drain(spark, counts, dirs, tails)


STREAM_RECON_CTE = """
o AS (SELECT o_orderkey AS order_id, o_orderdate AS order_ts FROM orders),
p AS (SELECT DISTINCT l_orderkey AS order_id, l_shipdate AS pay_ts FROM lineitem)
"""


@query(
    "stream_order_reconcile",
    f"""
WITH {STREAM_RECON_CTE}
SELECT 'matched' AS tag, o.order_id, o.order_ts, p.pay_ts
FROM o JOIN p ON o.order_id = p.order_id AND p.pay_ts BETWEEN o.order_ts AND o.order_ts + INTERVAL 30 DAY
UNION ALL
SELECT 'left_only' AS tag, order_id, order_ts, NULL AS pay_ts FROM o
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.order_id = o.order_id
                  AND p.pay_ts BETWEEN o.order_ts AND o.order_ts + INTERVAL 30 DAY)
UNION ALL
SELECT 'right_only' AS tag, order_id, NULL AS order_ts, pay_ts FROM p
WHERE NOT EXISTS (SELECT 1 FROM o WHERE p.order_id = o.order_id
                  AND p.pay_ts BETWEEN o.order_ts AND o.order_ts + INTERVAL 30 DAY)
""",
)
def stream_order_reconcile(spark, d):
    """Order/receipt reconciliation between two streams: full outer time-range
    join on the order with receipts due within 30 days of the
    order; matched pairs at once, orders without a receipt and receipts
    without an order once the watermark (min of both inputs, 1 day delay)
    rules out a partner.  Receipts of an order at one time are one receipt, so
    a hot order keeps few rows in the join."""
    dirs, tails = new_stream_dirs(spark, "reconcile"), []
    o = to_event_time(
        table_stream(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_ts")), "order_ts")
    o = watermarked(o, "order_ts", "1 day", tails, dirs["base"], closing_row=True)
    p = to_event_time(
        table_stream(spark, d, "lineitem").select(F.col("l_orderkey").alias("pay_order"), F.col("l_shipdate").alias("pay_ts")), "pay_ts")
    p = watermarked(p, "pay_ts", "1 day", tails, dirs["base"], closing_row=True)

    def tagged(j):
        return j.select(
            F.when(F.col("order_id").isNotNull() & F.col("pay_order").isNotNull(), "matched")
            .when(F.col("pay_order").isNull(), "left_only")
            .otherwise("right_only")
            .alias("tag"),
            F.coalesce("order_id", "pay_order").alias("order_id"),
            F.col("order_ts").cast("timestamp_ntz").alias("order_ts"),
            F.col("pay_ts").cast("timestamp_ntz").alias("pay_ts"),
        )

    return _range_join(spark, dirs, tails, o, p, 0 * DAY, "full_outer", tagged)
