"""Joins whose state holds a row for each of the input keep it on disk; the
session's settings come back."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from eventide.plans import streams
from eventide.streaming.sinks import state_on_disk

PARTS, PROVIDER = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
T0 = dt.datetime(2024, 1, 1)


def test_settings_come_back(spark):
    own = {k: spark.conf.get(k, None) for k in (PARTS, PROVIDER)}
    try:
        spark.conf.set(PARTS, "5000")
        spark.conf.unset(PROVIDER)
        unset = spark.conf.get(PROVIDER)
        with pytest.raises(KeyError), state_on_disk(spark):
            assert spark.conf.get(PROVIDER).endswith("RocksDBStateStoreProvider")
            assert 32 <= int(spark.conf.get(PARTS)) < 5000
            raise KeyError
        assert spark.conf.get(PARTS) == "5000" and spark.conf.get(PROVIDER) == unset
    finally:
        spark.conf.set(PARTS, own[PARTS])
        if own[PROVIDER] is not None:
            spark.conf.set(PROVIDER, own[PROVIDER])


@pytest.mark.parametrize("name", ["stream_order_reconcile", "stream_order_timeout"])
def test_order_joins_keep_state_on_disk(spark, tmp_path, monkeypatch, name):
    spark.createDataFrame([(1, T0), (2, T0), (3, T0)], "o_orderkey long, o_orderdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/o")
    pays = [(1, T0 + dt.timedelta(days=3)), (1, T0 + dt.timedelta(days=3)), (2, T0 + dt.timedelta(days=31))]
    spark.createDataFrame(pays, "l_orderkey long, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/l")
    for part, table in (("o", "orders"), ("l", "lineitem")):
        (file,) = (tmp_path / part).glob("*.parquet")
        (tmp_path / f"{table}.parquet").write_bytes(file.read_bytes())
    used, run = [], streams.run_available

    def seen(writer, checkpoint):
        used.append((spark.conf.get(PROVIDER), int(spark.conf.get(PARTS))))
        return run(writer, checkpoint)

    monkeypatch.setattr(streams, "run_available", seen)
    own = spark.conf.get(PARTS), spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        got = sorted(map(tuple, entry.queries()[name](spark, str(tmp_path)).collect()), key=str)
    finally:
        spark.conf.set(PARTS, own[0])
        spark.conf.set(PROVIDER, own[1])
    assert used and all(p.endswith("RocksDBStateStoreProvider") for p, _ in used)
    left = [2, 3]
    if name == "stream_order_timeout":
        assert got == [(k,) for k in left]
    else:
        want = [("matched", 1, T0, pays[0][1]), ("right_only", 2, None, pays[2][1]), *(("left_only", k, T0, None) for k in left)]
        assert got == sorted(want, key=str)
