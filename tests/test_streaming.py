"""Exactly-once behaviour of the streaming helpers: a drained stream
re-started on its checkpoint emits nothing new, and a replayed micro-batch
overwrites its own output."""

from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sources.tables import load
from eventide.streaming.late import late_split_writer
from eventide.streaming.sinks import run_available
from eventide.streaming.sources import new_stream_dirs, table_stream, to_event_time

from conftest import SF0001


def test_restart_on_drained_checkpoint_adds_nothing(spark):
    dirs = new_stream_dirs(spark, "t-restart")
    ev = to_event_time(table_stream(spark, SF0001, "events"))
    counts = (
        ev.withWatermark("ts", "10 minutes")
        .groupBy(F.window("ts", "1 hour"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.end").alias("window_end"), "n")
    )
    writer = counts.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append")
    run_available(writer, dirs["checkpoint"])
    first = spark.read.parquet(dirs["output"]).count()
    run_available(writer, dirs["checkpoint"])
    assert first > 0 and spark.read.parquet(dirs["output"]).count() == first


def test_replayed_batch_overwrites_its_output(spark):
    base = scratch_path(spark, "t-replay")
    out, state = f"{base}/out", f"{base}/state"
    batch = load(spark, SF0001, "events").select("event_id", "ts")
    fn = late_split_writer(state, out)
    fn(batch, 0)
    fn(batch, 1)
    fn(batch, 1)  # replay of batch 1
    res = spark.read.parquet(out)
    assert res.count() == 2 * batch.count()
    assert res.where("batch_id = 1 AND tag = 'late'").count() > 0  # batch 1 sees batch 0's watermark


def test_window_upsert_replaces_ranks_and_row_upsert_keeps_stale_ones(spark):
    import datetime as dt

    from eventide.streaming.sinks import read_upserted, upsert_windows

    w = dt.datetime(2024, 1, 1, 1)
    schema = "item_id long, cnt long, window_end timestamp_ntz, row_num long"
    first = spark.createDataFrame([(1, 5, w, 1), (2, 4, w, 2)], schema)
    second = spark.createDataFrame([(3, 9, w, 1), (1, 6, w, 2)], schema)  # item 2 left the top-2
    by_window, by_row = scratch_path(spark, "t-upw"), scratch_path(spark, "t-upr")
    for b in (first, second, second):  # the last write is a replay
        upsert_windows(b, by_window)
        upsert_windows(b, by_row, row_keys=["item_id", "window_end"])
    got_w = sorted((r.item_id, r.row_num) for r in read_upserted(spark, by_window).collect())
    got_r = sorted((r.item_id, r.row_num) for r in read_upserted(spark, by_row).collect())
    assert got_w == [(1, 2), (3, 1)]
    assert got_r == [(1, 2), (2, 2), (3, 1)]  # stale rank row of item 2 stays
