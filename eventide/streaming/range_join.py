"""Time-range join of two streams.

Spark's stream-stream join looks up and writes several state entries a row, so
it takes most of a millisecond a row and core thread once the state is on disk.
Here ``foreachBatch`` joins a micro-batch with what earlier ones brought as one
shuffled join, which spills, splits and combines like any other:

* rows are staged by micro-batch; rows behind the watermark in force (the least
  of both inputs') are late and dropped, equal rows of an input marked
  ``unique`` are one row; a row without a time pairs with none and no watermark
  passes it;
* pairs are emitted in the micro-batch of their later row, rows without a
  partner in the one whose watermark rules out a partner;
* state is the staged rows that the watermark leaves open and those in reach of
  them: a range of the stored event time, so closed row groups are not read.

Every folder is written under its batch id, so a replayed micro-batch reads the
same state and overwrites its own output."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.streaming.sinks import _read_or_none
from eventide.streaming.sources import END_OF_TIME

LEFT = "_left"
#: Rows a staged file, and settings that give a task about that many (a row has
#: few bytes): it sorts and combines them in memory.
FILE_ROWS = 1_000_000
SMALL_TASKS = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


@dataclass(frozen=True)
class Side:
    """An input of the join; column names of both are disjoint."""

    key: str
    ts: str
    delay: dt.timedelta
    unique: bool = False


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs as one stream of tagged rows."""
    return left.withColumn(LEFT, F.lit(True)).unionByName(right.withColumn(LEFT, F.lit(False)), allowMissingColumns=True)


def _us(d: dt.timedelta) -> int:
    return d // dt.timedelta(microseconds=1)


def _time(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def range_join_writer(
    spark: SparkSession,
    path: str,
    out: str,
    left: Side,
    right: Side,
    low: dt.timedelta | None,
    high: dt.timedelta,
    how: str,
    result: Callable[[DataFrame], DataFrame],
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over ``side_by_side`` inputs that still have
    their closing rows: ``left`` and ``right`` joined (``inner``, ``left_outer``
    or ``full_outer``) on equal keys and left time + ``low`` <= right time <=
    left time + ``high``; ``result`` of the rows due goes to ``out`` under the
    batch id.  Without ``low`` every right row stays open; then only those with
    the key of an open left row are joined."""
    if how not in ("inner", "left_outer", "full_outer") or (low is None and how == "full_outer"):
        raise ValueError(f"no {how} join with the range {low}, {high}")
    lo, hi = None if low is None else _us(low), _us(high)
    match = (F.col(left.key) == F.col(right.key)) & (F.col(right.ts) <= F.col(left.ts) + F.lit(high))
    if low is not None:
        match = match & (F.col(right.ts) >= F.col(left.ts) + F.lit(low))

    def watermark(marks) -> int | None:
        """Least of both inputs'; None until both have rows."""
        if marks is None or marks.l is None or marks.r is None:
            return None
        return min(marks.l - _us(left.delay), marks.r - _us(right.delay))

    def fn(batch: DataFrame, batch_id: int) -> None:
        old = _read_or_none(spark, f"{path}/marks/batch_id={batch_id - 1}")
        before = None if old is None else old.first()
        wm = watermark(before)
        at = F.coalesce(left.ts, right.ts)
        on_time = batch.where(at.isNotNull()) if wm is None else batch.where(at > _time(wm))
        on_time.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).parquet(f"{path}/rows/batch_id={batch_id}")
        latest = spark.read.parquet(f"{path}/rows/batch_id={batch_id}").agg(
            *[F.max(F.unix_micros(side.ts)).alias(m) for side, m in ((left, "l"), (right, "r"))])
        marks = latest if old is None else latest.unionByName(old).agg(F.max("l").alias("l"), F.max("r").alias("r"))
        marks.write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        now = watermark(spark.read.parquet(f"{path}/marks/batch_id={batch_id}").first())

        rows = spark.read.parquet(f"{path}/rows").where(F.col("batch_id") <= batch_id)
        tag = batch.columns.index(LEFT)
        cols = {left: batch.columns[:tag], right: batch.columns[tag + 1 :]}
        a, b = (rows.where((F.col(LEFT) == (side is left)) & (F.col(side.ts) < F.lit(END_OF_TIME))).select(*cols[side], "batch_id") for side in (left, right))
        # late rows are at the watermark or before; a row is closed, like in Spark's
        # join, when the watermark is after its last partner's time
        if wm is not None:  # open rows, and what they may have been paired with
            a = a.where(F.col(left.ts) >= _time(wm - hi))
            if lo is not None:
                b = b.where(F.col(right.ts) >= _time(wm - hi + lo))
            else:
                b = b.join(a.select(F.col(left.key).alias(right.key)).distinct(), right.key, "left_semi")
        a, b = (
            x.groupBy(*cols[side]).agg(F.min("batch_id").alias(of)) if side.unique else x.withColumnRenamed("batch_id", of)
            for x, side, of in ((a, left, "_l"), (b, right, "_r"))
        )
        joined = a.join(b, match, how)

        pair = F.col("_l").isNotNull() & F.col("_r").isNotNull()
        due = pair & ((F.col("_l") == batch_id) | (F.col("_r") == batch_id))
        if now is not None:
            due = due | (F.col("_r").isNull() & (F.col(left.ts) < _time(now - hi)))
            if how == "full_outer":
                passed = F.col("_l").isNull() & (F.col(right.ts) < _time(now + lo))
                due = due | (passed if wm is None else passed & (F.col(right.ts) >= _time(wm + lo)))
        result(joined.where(due).drop("_l", "_r")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return fn
