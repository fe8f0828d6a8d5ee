"""Late data on streams.

Structured Streaming drops rows behind the watermark without a trace.  The
late-row side output is kept here in ``foreachBatch``: a small table with
one row per micro-batch (its max event time) gives the watermark in force
for the next batch, each batch is split against it, and both the split and
the batch's max are written under the batch id, so a replayed batch
overwrites its own output (idempotent).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from eventide.operators.windows import _dur_seconds
from eventide.streaming.sources import run_in_slices


#: Later than every window (the year 9000).
END_US = 221_845_392_000_000_000


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _max_before(spark: SparkSession, state_path: str, batch_id: int):
    """Max event time (epoch micros) of all batches before ``batch_id``: the
    previous batch stores the running max, so one tiny file is read; the
    full state is scanned only if that file is missing (first batch)."""
    for path, cond in ((f"{state_path}/batch={batch_id - 1}", None), (state_path, F.col("batch_id") < batch_id)):
        try:
            df = spark.read.parquet(path)
        except AnalysisException as ex:
            if ex.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if cond is not None:
            df = df.where(cond)
        row = df.agg(F.max("mx").alias("mx")).first()
        return None if row is None else row.mx
    return None


def late_split_writer(state_path: str, out_path: str, ts: str = "ts", delay_us: int = 0):
    """``foreachBatch`` function: tag rows late (event time below the
    watermark of earlier batches) or main, write them under the batch id,
    and store the running max event time for the next batch."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()  # one micro-batch, read by two writes
        try:
            prev = _max_before(spark, state_path, batch_id)
            wm = None if prev is None else prev - delay_us
            late = F.lit(False) if wm is None else (_micros(ts) < F.lit(wm))
            tagged = batch.withColumn("tag", F.when(late, "late").otherwise("main"))
            tagged.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
            running = F.max(_micros(ts)) if prev is None else F.greatest(F.max(_micros(ts)), F.lit(prev))
            (
                batch.agg(F.coalesce(running, F.lit(prev)).alias("mx"))
                .withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite")
                .parquet(f"{state_path}/batch={batch_id}")
            )
        finally:
            batch.unpersist()

    return fn


def firing_log_writer(
    path: str, key: str, size: str, lateness: str, ts: str = "ts", delay_us: int = 0
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the firings of tumbling windows with allowed
    lateness, each with the window's count so far, go to ``path/firings`` under
    the batch id.

    A window fires ``first`` in the micro-batch that brings the watermark to
    its end, or in the first that brings it rows after that, and as an
    ``update`` in each later one with rows for it, until the watermark in force
    is ``lateness`` past its end.  Only the counts of windows that fire are read
    again.  ``close_firing_log`` fires what the end of the input closes."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = _max_before(spark, f"{path}/batch-max", batch_id)
        wm = None if prev is None else prev - delay_us
        end = F.window(F.col(ts), size).end
        rows = batch.where(F.col(ts).isNotNull()).select(key, end.alias("window_end"), _micros(ts).alias("_us"))
        if wm is not None:
            rows = rows.where(_micros("window_end") + F.lit(_dur_seconds(lateness) * 1_000_000) > F.lit(wm))
        # rows that are dropped do not move the watermark either: they are older than it
        counts = rows.groupBy(key, "window_end").agg(F.count(F.lit(1)).alias("n"), F.max("_us").alias("mx"))
        counts.write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")
        top = spark.read.parquet(f"{path}/counts/batch_id={batch_id}").agg(F.max("mx")).first()[0]
        last = max((x for x in (top, prev) if x is not None), default=None)
        after = None if last is None else last - delay_us
        _fire(spark, path, key, batch_id, wm, after, _dur_seconds(lateness) * 1_000_000)
        schema = "mx long, batch_id int"
        spark.createDataFrame([(last, batch_id)], schema).write.mode("overwrite").parquet(f"{path}/batch-max/batch={batch_id}")

    return fn


def _fire(spark: SparkSession, path: str, key: str, batch_id: int, wm: int | None, after: int | None, lateness_us: int) -> None:
    """Firings of a micro-batch that takes the watermark from ``wm`` to
    ``after`` (microseconds; None: no row yet)."""
    counts = spark.read.parquet(f"{path}/counts").where(F.col("batch_id") <= batch_id)
    end = _micros("window_end")
    open_before = F.lit(True) if wm is None else end > wm
    closes = open_before & (F.lit(False) if after is None else end <= after)
    mine = F.max((F.col("batch_id") == batch_id).cast("int")) == 1
    earlier = F.max((F.col("batch_id") < batch_id).cast("int")) == 1
    # later windows stay open, and earlier ones take no more rows: their counts are not read

    def stored(us: int):  # a constant of the column's type, for the scan
        return F.timestamp_micros(F.lit(us)).cast("timestamp_ntz")

    reached = counts.where(F.lit(False) if after is None else F.col("window_end") <= stored(after))
    if wm is not None:
        reached = reached.where(F.col("window_end") > stored(wm - lateness_us))
    state = reached.groupBy(key, "window_end").agg(F.sum("n").alias("n"), mine.alias("mine"), earlier.alias("earlier"))
    fired = state.where(closes | F.col("mine"))
    kind = F.when(closes | ~F.col("earlier"), "first").otherwise("update")
    fired.select(key, "window_end", "n", kind.alias("kind")).write.mode("overwrite").parquet(f"{path}/firings/batch_id={batch_id}")


def close_firing_log(spark: SparkSession, path: str, key: str, lateness: str, delay_us: int = 0) -> None:
    """The final watermark: windows still open fire once."""
    row = spark.read.parquet(f"{path}/batch-max").agg(F.max_by("mx", "batch_id"), F.max("batch_id")).first()
    if row[1] is not None:
        counts = spark.read.parquet(f"{path}/counts/batch_id={row[1]}").limit(0)
        counts.write.mode("overwrite").parquet(f"{path}/counts/batch_id={row[1] + 1}")
        wm = None if row[0] is None else row[0] - delay_us
        _fire(spark, path, key, row[1] + 1, wm, END_US, _dur_seconds(lateness) * 1_000_000)


def arrival_slices(df: DataFrame, arrival: str, trigger_days: int) -> list[dt.datetime]:
    """Epoch-aligned slice bounds of ``trigger_days`` covering the arrival
    times (two scalars reach the driver)."""
    r = df.agg(F.min(arrival).alias("lo"), F.max(arrival).alias("hi")).first()
    if r.lo is None:
        return []
    step = dt.timedelta(days=trigger_days)
    epoch = dt.datetime(1970, 1, 1)
    k = (r.lo - epoch) // step
    b = epoch + (k + 1) * step
    out = []
    while b <= r.hi:
        out.append(b)
        b += step
    return out


def run_per_slice(df: DataFrame, arrival: str, trigger_days: int, input_path: str, run, ts: str, longest: dt.timedelta) -> None:
    """Micro-batches = epoch-aligned arrival slices of ``trigger_days``.  A row
    arrives within ``longest`` of its time ``ts``, so a slice is also a range of
    that stored column, which the scan of the table can take."""

    def stored(lo, hi):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(ts) >= F.lit(lo - longest))
        return cond if hi is None else cond & (F.col(ts) < F.lit(hi))

    run_in_slices(df, arrival, arrival_slices(df, arrival, trigger_days), input_path, run, stored)
