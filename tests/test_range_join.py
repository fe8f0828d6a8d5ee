"""The time-range join over ``foreachBatch`` against Spark's stream-stream
join: the same rows after every micro-batch, with late rows, equal rows, null
keys and times; a replayed micro-batch; the queries that use it."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eventide.plans import streams
from eventide.streaming.range_join import SMALL_TASKS, Side, range_join_writer, side_by_side
from eventide.streaming.sinks import run_available, state_on_disk
from eventide.streaming.sources import dir_stream, new_stream_dirs, watermarked

T0, DAY, PARTS = dt.datetime(2024, 1, 1), dt.timedelta(days=1), "spark.sql.shuffle.partitions"
O_SCHEMA, P_SCHEMA = "order_id long, order_ts timestamp", "pay_order long, pay_ts timestamp"
RANGE = {"full_outer": 0 * DAY, "left_outer": None}


def slices():
    """Orders and payments of three micro-batches, in time order but for some
    rows that come one or two micro-batches late or twice."""
    rnd = random.Random(7)
    out = [([], []) for _ in range(3)]
    for side in range(2):
        for _ in range(150):
            i, key = rnd.randrange(3), rnd.choice([None, *range(40)])
            day = i * 40 + rnd.randrange(40)
            late = min(2, i + rnd.choice([0, 0, 0, 0, 1, 2]))
            row = (key, None if rnd.random() < 0.05 else T0 + day * DAY)
            for _ in range(rnd.choice([1, 1, 2])):
                out[late][side].append(row)
    return out


@pytest.fixture
def two_parts(spark):
    own = spark.conf.get(PARTS)
    spark.conf.set(PARTS, "2")
    yield spark
    spark.conf.set(PARTS, own)


@pytest.mark.parametrize("how", ["full_outer", "left_outer"])
def test_equals_sparks_join_after_every_batch(two_parts, how):
    spark, low, seen = two_parts, RANGE[how], {}
    cond = "order_id = pay_order AND pay_ts <= order_ts + INTERVAL 30 DAYS"
    if low is not None:
        cond += " AND pay_ts >= order_ts"
    for own in (False, True):
        dirs, tails = new_stream_dirs(spark, "range-join"), []
        o, p = (
            watermarked(dir_stream(spark, f"{dirs['input']}/{x}-*", schema), ts, "1 day", tails, dirs["base"], closing_row=own)
            for x, schema, ts in (("o", O_SCHEMA, "order_ts"), ("p", P_SCHEMA, "pay_ts"))
        )
        if own:
            left, right = Side("order_id", "order_ts", DAY), Side("pay_order", "pay_ts", DAY, unique=True)
            fn = range_join_writer(spark, f"{dirs['base']}/state", dirs["output"], left, right, low, 30 * DAY, how, lambda j: j)
            writer = side_by_side(o, p).writeStream.foreachBatch(fn)
        else:
            j = o.join(p.dropDuplicates(["pay_order", "pay_ts"]), F.expr(cond), how)
            writer = j.writeStream.format("parquet").option("path", dirs["output"])
        for i, (orders, pays) in enumerate(slices()):
            spark.createDataFrame(orders, O_SCHEMA).coalesce(1).write.parquet(f"{dirs['input']}/o-{i}")
            spark.createDataFrame(pays, P_SCHEMA).coalesce(1).write.parquet(f"{dirs['input']}/p-{i}")
            run_available(writer, dirs["checkpoint"])
            seen[own, i] = found(spark, dirs["output"])
        for tail in tails:
            tail.close(spark)
        run_available(writer, dirs["checkpoint"])
        seen[own, "end"] = found(spark, dirs["output"])
    for i in (0, 1, 2, "end"):
        assert seen[True, i] == seen[False, i], i
    assert len(seen[True, 0]) < len(seen[True, 2]) < len(seen[True, "end"])


def found(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("order_id", "order_ts", "pay_order", "pay_ts").collect()), key=str)


def test_replayed_batch_overwrites_its_rows(spark, tmp_path):
    left, right = Side("order_id", "order_ts", DAY), Side("pay_order", "pay_ts", DAY, unique=True)
    fn = range_join_writer(spark, f"{tmp_path}/state", f"{tmp_path}/out", left, right, 0 * DAY, 30 * DAY, "full_outer", lambda j: j)
    batches = [
        ([(1, T0), (2, T0)], [(1, T0 + DAY), (1, T0 + DAY)]),
        ([(3, T0 + 60 * DAY)], [(1, T0 + 2 * DAY), (1, T0 + DAY), (3, T0 + 61 * DAY)]),
    ]
    want = [(1, T0, 1, T0 + DAY), (1, T0, 1, T0 + 2 * DAY), (2, T0, None, None), (3, T0 + 60 * DAY, 3, T0 + 61 * DAY)]
    for i in (0, 0, 1, 1):
        o, p = batches[i]
        fn(side_by_side(spark.createDataFrame(o, O_SCHEMA), spark.createDataFrame(p, P_SCHEMA)), i)
    assert found(spark, f"{tmp_path}/out") == sorted(want, key=str)


def test_a_right_row_without_end_needs_a_left_join(spark):
    with pytest.raises(ValueError):
        range_join_writer(spark, "s", "o", Side("a", "b", DAY), Side("c", "d", DAY), None, DAY, "full_outer", lambda j: j)


@pytest.mark.parametrize("name", ["stream_order_reconcile", "stream_order_timeout"])
def test_order_joins_have_no_state_entry_a_row(spark, tmp_path, monkeypatch, name):
    for table, schema, rows in (
        ("orders", "o_orderkey long, o_orderdate timestamp_ntz", [(k, T0 + k * DAY) for k in range(50)]),
        ("lineitem", "l_orderkey long, l_shipdate timestamp_ntz", [(k, T0 + (k + 20 * (k % 3)) * DAY) for k in range(60)] * 2),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}")
        (file,) = (tmp_path / table).glob("*.parquet")
        (tmp_path / f"{table}.parquet").write_bytes(file.read_bytes())
    ran = []
    monkeypatch.setattr(streams, "run_available", lambda *a: ran.append(run_available(*a)))
    got = sorted(map(tuple, entry.queries()[name](spark, str(tmp_path)).collect()), key=str)
    late = [k for k in range(50) if k % 3 == 2]
    if name == "stream_order_timeout":
        assert got == sorted(((k,) for k in late), key=str)
    else:
        paid = [("matched", k, T0 + k * DAY, T0 + (k + 20 * (k % 3)) * DAY) for k in range(50) if k % 3 < 2]
        alone = [("right_only", k, None, T0 + (k + 20 * (k % 3)) * DAY) for k in range(60) if k % 3 == 2 or k >= 50]
        assert got == sorted(paid + alone + [("left_only", k, T0 + k * DAY, None) for k in late], key=str)
    assert ran and not any(p["stateOperators"] for q in ran for p in q.recentProgress)


def test_settings_in_place_of_few_partitions(spark):
    own = {k: spark.conf.get(k, None) for k in (PARTS, *SMALL_TASKS)}
    with state_on_disk(spark, SMALL_TASKS):
        assert spark.conf.get(PARTS) == own[PARTS]
        assert {k: spark.conf.get(k) for k in SMALL_TASKS} == SMALL_TASKS
    assert {k: spark.conf.get(k, None) for k in own} == own
