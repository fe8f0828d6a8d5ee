"""Late data in micro-batch terms, computed in batch.

Structured Streaming keeps one watermark per query: before micro-batch b it
is max(event time of all earlier batches) - delay.  Given an arrival-time
column, these operators reproduce that rule exactly and classify rows and
windows, including the rows a streaming aggregation would silently drop.
The watermark table has one row per micro-batch (bounded by the time span,
not by the data) and is joined back by batch id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.keyed import keyed_prefix
from eventide.operators.windows import bucket_end, interval


def disordered_arrival(events: DataFrame, ts: str = "ts", max_delay_s: int = 10800, stride: int = 7919) -> Column:
    """Deterministic arrival time: ts + ((event_id * stride) mod max_delay) s."""
    return F.col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") * stride) % max_delay_s)


def _batches(df: DataFrame, ts: str, arrival: str, trigger: str) -> DataFrame:
    """(batch, _mx): the latest event time of each micro-batch."""
    return df.groupBy(F.window(F.col(arrival), trigger).start.alias("batch")).agg(F.max(ts).alias("_mx"))


def batch_watermarks(df: DataFrame, ts: str, arrival: str, trigger: str, delay: str = "0 seconds") -> DataFrame:
    """(batch, watermark): watermark in force while a batch runs (null for the
    first): a running maximum over one row per micro-batch, scanned in time
    buckets."""
    per = _batches(df, ts, arrival, trigger).withColumn("_all", F.lit(0))
    run = keyed_prefix(per, "_all", ["batch"], F.col("_mx"), "_wm", agg="max", bucket="30 days", exclusive=True)
    return run.select("batch", (F.col("_wm") - interval(delay)).alias("watermark"))


def with_watermark(df: DataFrame, ts: str, arrival: str, trigger: str, delay: str = "0 seconds") -> DataFrame:
    wm = batch_watermarks(df, ts, arrival, trigger, delay)
    return df.withColumn("batch", F.window(F.col(arrival), trigger).start).join(wm, "batch", "left")


def split_late_records(df: DataFrame, ts: str, arrival: str, trigger: str, delay: str = "0 seconds") -> DataFrame:
    """tag = late when the row's time is below the watermark of its batch."""
    w = with_watermark(df, ts, arrival, trigger, delay)
    late = F.col("watermark").isNotNull() & (F.col(ts) < F.col("watermark"))
    return w.withColumn("tag", F.when(late, "late").otherwise("main"))


def split_late_windows(
    df: DataFrame, ts: str, arrival: str, trigger: str, size: str, delay: str = "0 seconds"
) -> DataFrame:
    """tag = late when the row's tumbling window had closed (end <= watermark)
    before its batch ran: the rows a windowed aggregation drops."""
    w = with_watermark(df, ts, arrival, trigger, delay).withColumn("window_end", F.window(F.col(ts), size).end)
    late = F.col("watermark").isNotNull() & (F.col("window_end") <= F.col("watermark"))
    return w.withColumn("tag", F.when(late, "late").otherwise("main"))


def lateness_classes(
    df: DataFrame,
    key: str,
    ts: str,
    arrival: str,
    trigger: str,
    size: str,
    lateness: str,
    delay: str = "0 seconds",
) -> DataFrame:
    """Per (key, window): rows on time, late but within the allowed lateness
    (they re-fire the window), and dropped."""
    w = with_watermark(df, ts, arrival, trigger, delay).withColumn("window_end", F.window(F.col(ts), size).end)
    wm = F.col("watermark")
    on_time = wm.isNull() | (F.col("window_end") > wm)
    dropped = wm.isNotNull() & (F.col("window_end") + interval(lateness) <= wm)
    return w.groupBy(key, "window_end").agg(
        F.count(F.when(on_time, 1)).alias("n_on_time"),
        F.count(F.when(~on_time & ~dropped, 1)).alias("n_late_kept"),
        F.count(F.when(dropped, 1)).alias("n_dropped"),
    )


def early_fire_counts(df: DataFrame, key: str, ts: str, size: str, step: str) -> DataFrame:
    """Event-time early firing: every ``step`` with data a (key, window) emits
    its running count, and every window fires at its end, whether its last
    step holds rows or not.  Steps without rows in between fire nothing: their
    count is the previous one.  Aggregates to (key, window, step) first; no
    row is expanded per firing."""
    steps = df.groupBy(
        key, F.window(F.col(ts), size).end.alias("window_end"), bucket_end(F.col(ts), step).alias("fire_ts")
    ).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(key, "window_end").orderBy("fire_ts").rowsBetween(Window.unboundedPreceding, 0)
    after = F.lead("fire_ts").over(Window.partitionBy(key, "window_end").orderBy("fire_ts"))
    fires = steps.select(key, "window_end", "fire_ts", F.sum("_c").over(w).alias("n"), after.isNull().alias("_last"))
    end_too = F.when(
        F.col("_last") & (F.col("fire_ts") < F.col("window_end")), F.array("fire_ts", "window_end")
    ).otherwise(F.array("fire_ts"))
    return fires.select(key, "window_end", F.explode(end_too).alias("fire_ts"), "n")


def _closing_batches(df: DataFrame, ends: DataFrame, ts: str, arrival: str, trigger: str, delay: str) -> DataFrame:
    """(window_end, closed_in): the micro-batch whose rows bring the watermark
    to a window's end; null where only the end of the input does.

    The watermark never falls, so that batch is the last one that starts below
    the end, if it brings the watermark there: a running maximum over ends and
    batches in the order of their watermarks, scanned in time buckets."""
    per = _batches(df, ts, arrival, trigger).withColumn("_all", F.lit(0))
    run = keyed_prefix(per, "_all", ["batch"], F.col("_mx"), "_wm", agg="max", bucket="30 days", exclusive=True)
    run = run.withColumn("_at", F.col("_wm") - interval(delay))
    after = F.greatest("_wm", "_mx") - interval(delay)
    steps = run.select("_all", "_at", F.lit(1).alias("_kind"), F.struct("batch", after.alias("after")).alias("_batch"))
    marks = ends.select(F.lit(0).alias("_all"), F.col("window_end").alias("_at"), F.lit(0).alias("_kind"))
    merged = keyed_prefix(steps.unionByName(marks, allowMissingColumns=True), "_all", ["_at", "_kind"], F.col("_batch"), "_last", agg="max", bucket="30 days")
    closed = F.when(F.col("_last.after") >= F.col("_at"), F.col("_last.batch"))
    return merged.where("_kind = 0").select(F.col("_at").alias("window_end"), closed.alias("closed_in"))


def lateness_firings(
    df: DataFrame,
    key: str,
    ts: str,
    arrival: str,
    trigger: str,
    size: str,
    lateness: str,
    delay: str = "0 seconds",
) -> DataFrame:
    """(key, window_end, fired_in, n, kind): every firing of every window with
    allowed lateness.

    A window fires ``first`` in the micro-batch that brings the watermark to
    its end, or in the first one that brings it rows after that; it fires
    again, as an ``update``, in each later micro-batch with rows for it until
    the watermark in force is ``lateness`` past its end; later rows are dropped.
    ``n`` counts its rows so far.  ``fired_in`` is null for windows that only
    the end of the input closes."""
    w = with_watermark(df, ts, arrival, trigger, delay).withColumn("window_end", F.window(F.col(ts), size).end)
    kept = w.where(F.col("watermark").isNull() | (F.col("window_end") + interval(lateness) > F.col("watermark")))
    counts = kept.groupBy(key, "window_end", "batch").agg(F.count(F.lit(1)).alias("_c"))
    closing = _closing_batches(df, counts.select("window_end").distinct(), ts, arrival, trigger, delay)
    fired = F.when(F.col("closed_in").isNotNull(), F.greatest("batch", "closed_in"))
    firings = counts.join(closing, "window_end").groupBy(key, "window_end", fired.alias("fired_in")).agg(F.sum("_c").alias("_c"))
    # a window's firings: no more than the micro-batches in its size and lateness
    order = Window.partitionBy(key, "window_end").orderBy(F.col("fired_in").asc_nulls_last())
    return firings.select(
        key,
        "window_end",
        "fired_in",
        F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
        F.when(F.row_number().over(order) == 1, "first").otherwise("update").alias("kind"),
    )


def firing_grid(df: DataFrame, key: str, ts: str, size: str, step: str) -> DataFrame:
    """(key, window_end, fire_ts, n): early firing on the progress of the
    watermark, which all keys move together.

    From the step of its first row on, a window fires whenever the watermark
    enters a further step, whether rows of its own key did that or not, and at
    its end; ``n`` counts its rows before that step.  Steps that no row of any
    key falls into are passed over.

    The open windows, one row each, are laid on the grid (``size / step`` rows
    at most) and kept where the steps entered have a row; counts are taken by
    (key, window, step) first."""
    start = bucket_end(F.col(ts), step) - interval(step)
    cells = df.where(F.col(ts).isNotNull()).groupBy(key, F.window(F.col(ts), size).end.alias("window_end"), start.alias("_step")).agg(F.count(F.lit(1)).alias("_c"))
    entered = df.where(F.col(ts).isNotNull()).select(start.alias("fire_ts")).distinct()
    open_from = cells.groupBy(key, "window_end").agg(F.min("_step").alias("_first"))
    grid = open_from.select(key, "window_end", F.explode(F.sequence(F.col("_first") + interval(step), F.col("window_end"), interval(step))).alias("fire_ts"))
    early = grid.where(F.col("fire_ts") < F.col("window_end")).join(entered, "fire_ts", "left_semi")
    fires = early.unionByName(open_from.select(key, "window_end", F.col("window_end").alias("fire_ts")))
    # a step's rows count from the next step on
    counted = cells.select(key, "window_end", (F.col("_step") + interval(step)).alias("fire_ts"), "_c", F.lit(0).alias("_fire"))
    both = counted.unionByName(fires.select(key, "window_end", "fire_ts", F.lit(0).cast("long").alias("_c"), F.lit(1).alias("_fire")))
    w = Window.partitionBy(key, "window_end").orderBy("fire_ts", "_fire").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("n", F.sum("_c").over(w)).where("_fire = 1").select(key, "window_end", "fire_ts", "n")
