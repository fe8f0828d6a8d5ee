"""Streaming sources over the driver tables and staged copies of them.

A table file is read as a file stream with ``pathGlobFilter``; staged copies
(time slices written one after another) give several micro-batches in event
time order, the shape the reference's ascending-time sources have.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import ensure_utc, scratch_path


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """One driver table as a file stream (schema taken from the file)."""
    ensure_utc(spark)
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(sf_dir)


def dir_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """File stream over ``path`` (a glob).  ``max_files`` bounds a micro-batch
    by file count; files of one batch are not taken in time order, so with
    event-time state prefer draining whole slices (``run_in_slices``)."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def stage_slices(df: DataFrame, path: str, ts: str, bounds: list, start_index: int = 0) -> list[str]:
    """Write ``df`` as consecutive event-time slices [b_i, b_i+1) into
    ``path/slice-<i>``.  Returns the slice paths."""
    out = []
    edges = [None, *bounds, None]
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(ts) >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col(ts) < F.lit(hi))
        p = f"{path}/slice-{start_index + i:04d}"
        df.where(cond).write.mode("overwrite").parquet(p)
        out.append(p)
    return out


def run_in_slices(df: DataFrame, ts: str, bounds: list, input_path: str, run, stored=None) -> None:
    """Stage one event-time slice [b_i, b_i+1) at a time under
    ``input_path/slice-<i>`` and let ``run()`` drain it (``availableNow`` on
    one checkpoint): every micro-batch is exactly one slice, however many
    files the slice was written as.  Where ``ts`` is computed, ``stored(lo, hi)``
    gives a condition on stored columns that every row of a slice meets."""
    edges = [None, *bounds, None]
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(ts) >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col(ts) < F.lit(hi))
        part = df if stored is None else df.where(stored(lo, hi))
        stage_slices(part.where(cond), input_path, ts, [], i)
        run()


def time_quantiles(df: DataFrame, ts: str, n: int) -> list:
    """n-1 event-time cut points splitting ``df`` into n similar slices
    (approximate quantiles: one pass, bounded memory)."""
    if n <= 1:
        return []
    us = F.unix_micros(F.col(ts).cast("timestamp")).cast("double")
    qs = df.select(us.alias("_u")).approxQuantile("_u", [i / n for i in range(1, n)], 0.001)
    import datetime as _dt

    epoch = _dt.datetime(1970, 1, 1)
    return sorted({epoch + _dt.timedelta(microseconds=int(q)) for q in qs})


def new_stream_dirs(spark: SparkSession, name: str) -> dict[str, str]:
    base = scratch_path(spark, name)
    return {"base": base, "input": f"{base}/input", "output": f"{base}/output", "checkpoint": f"{base}/checkpoint"}


#: Event time of the row that ends an input: later than every real one.
END_OF_TIME = dt.datetime(9000, 1, 1)


@dataclass(frozen=True)
class Tail:
    """Folder that ends one input of a bounded stream."""

    path: str
    ts: str
    schema: T.StructType

    def close(self, spark: SparkSession) -> None:
        """Write the closing row: null but for its event time."""
        row = [F.lit(END_OF_TIME if f.name == self.ts else None).cast(f.dataType).alias(f.name) for f in self.schema]
        spark.range(1).select(*row).write.mode("overwrite").parquet(f"{self.path}/closed")


def watermarked(stream: DataFrame, ts: str, delay: str, tails: list[Tail], base: str, closing_row: bool = False) -> DataFrame:
    """``stream`` with a watermark that can be brought to its end.

    Spark keeps what the last row's watermark leaves open; a bounded source
    ends with a final watermark that closes all windows, timers and joins.
    The stream is joined by a second folder, empty until ``Tail.close`` puts a
    row of ``END_OF_TIME`` there: that row moves the watermark and goes no
    further.  (The filter names the event time, so it is not pushed below the
    watermark.)  With ``closing_row`` it is left in, for an operator that keeps
    the watermark itself.  The tail is added to ``tails``, to be closed by
    ``run_to_the_end``."""
    tail = Tail(f"{base}/tail-{len(tails)}", ts, stream.schema)
    spark = stream.sparkSession
    # a query built anew on the same folders and checkpoint finds its tail again
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{tail.path}/open")
    tails.append(tail)
    both = stream.unionByName(spark.readStream.schema(stream.schema).parquet(f"{tail.path}/*"))
    marked = both.withWatermark(ts, delay)
    return marked if closing_row else marked.where(F.col(ts).isNull() | (F.col(ts) < F.lit(END_OF_TIME)))


def run_to_the_end(run, spark: SparkSession, tails: list[Tail]) -> None:
    """``run()`` drains what the inputs hold; then every input is closed and
    drained again on the same checkpoint."""
    run()
    for tail in tails:
        tail.close(spark)
    run()


def to_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not NTZ); the session zone is UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a socket (the reference's interactive source).  Not
    fault tolerant - for demos only; tests use file streams, no ports."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
