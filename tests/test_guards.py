"""Errors that must not pass for "no data"."""

import pytest
from pyspark.errors import AnalysisException

from eventide.session import scratch_path
from eventide.sources.tables import load
from eventide.streaming.sinks import _read_or_none, run_available
from eventide.streaming.sources import new_stream_dirs

from conftest import SF0001


def test_missing_target_is_none_and_a_broken_one_an_error(spark):
    path = scratch_path(spark, "t-target")
    assert _read_or_none(spark, path) is None
    spark.sparkContext._jvm.java.io.File(path.removeprefix("file:")).mkdirs()
    with pytest.raises(AnalysisException):
        _read_or_none(spark, path)


def test_undrained_stream_is_an_error(spark):
    dirs = new_stream_dirs(spark, "t-undrained")
    schema = load(spark, SF0001, "events").schema

    def slow(batch, _):
        import time

        time.sleep(8)

    src = spark.readStream.schema(schema).parquet(f"{SF0001}/events.parquet*")
    with pytest.raises(TimeoutError):
        run_available(src.writeStream.foreachBatch(slow), dirs["checkpoint"], timeout_s=2)
