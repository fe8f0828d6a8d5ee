"""Keyed state processors hold a key bucket a call: the number of calls and of
state rows is that of the buckets, however many keys there are, and the results
are those of each key by itself, the null key included."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.streaming.sinks import run_available
from eventide.streaming.sources import dir_stream, new_stream_dirs, run_in_slices, run_to_the_end, to_event_time, watermarked
from eventide.streaming.state import jump_alerts, login_fail_alerts, two_step_with_timeout

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "user_id long, ts timestamp_ntz, event_id long, event_type string, temperature double"
KEYS = [None, *[2**53 + k for k in range(120)]]  # too large for doubles


def rows(seed):
    r = random.Random(seed)
    kinds = ["fail", "fail", "fail", "ok", "buy"]
    return [
        (r.choice(KEYS), T0 + dt.timedelta(minutes=r.randrange(2000)), i, r.choice(kinds), r.choice([None, *map(float, range(9))]))
        for i in range(1500)
    ]


def by_key(data):
    keys = defaultdict(list)
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        keys[row[0]].append(row)
    return keys


def run(spark, data, operator, buckets=4):
    """Rows that ``operator`` gives over three slices and the end; checks the
    number of state rows."""
    df = spark.createDataFrame(data, SCHEMA)
    dirs, tails, done = new_stream_dirs(spark, "t-buckets"), [], []
    src = watermarked(to_event_time(dir_stream(spark, f"{dirs['input']}/slice-*", df.schema)), "ts", "0 seconds", tails, dirs["base"])
    w = operator(src, buckets).writeStream.format("parquet").option("path", dirs["output"]).outputMode("append")

    def go():
        done.append(run_available(w, dirs["checkpoint"]))

    run_in_slices(df, "ts", [T0 + dt.timedelta(minutes=m) for m in (600, 1300)], dirs["input"], go)
    run_to_the_end(go, spark, tails)
    held = [s["numRowsTotal"] for q in done for p in q.recentProgress for s in p["stateOperators"]]
    assert 0 < max(held) <= buckets + 1  # and the null key's
    return spark.read.parquet(dirs["output"])


@pytest.fixture(autouse=True)
def two_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_jumps_by_bucket(spark):
    data = rows(1)
    got = run(spark, data, lambda s, n: jump_alerts(s, 5.0, n)).collect()
    want = {
        (k, b[2], a[4], b[4])
        for k, xs in by_key(data).items()
        for a, b in zip(xs, xs[1:])
        if a[4] is not None and b[4] is not None and abs(b[4] - a[4]) > 5
    }
    assert len(got) == len(want) and {(r.user_id, r.event_id, r["last"], r.cur) for r in got} == want
    assert any(k is None for k, *_ in want)


def test_two_steps_by_bucket(spark):
    data = rows(2)
    got = run(spark, data, lambda s, n: two_step_with_timeout(s, "event_type", "ok", "buy", 7200, n)).collect()
    want, limit = [], dt.timedelta(hours=2)
    for k, xs in by_key(data).items():
        for a, b in zip(xs, [*xs[1:], None]):
            if a[3] == "ok" and (b is None or b[1] >= a[1] + limit):
                want.append((k, a[2], "timeout"))
            elif a[3] == "ok" and b[3] == "buy":
                want.append((k, a[2], "matched"))
    assert sorted(map(str, ((r.user_id, r.event_id, r.outcome) for r in got))) == sorted(map(str, want))
    assert {o for _, _, o in want} == {"timeout", "matched"}


def test_login_timers_by_bucket(spark):
    data = rows(3)
    alerts = run(spark, data, lambda s, n: login_fail_alerts(s, 6 * 3600, 2, n))
    got = [(r.user_id, r.t, r.fails) for r in alerts.select("user_id", F.col("first_fail").cast("timestamp_ntz").alias("t"), "fails").collect()]
    want, limit = [], dt.timedelta(hours=6)
    for k, xs in by_key(data).items():
        first, fails, waiting = None, 0, False
        for _, ts, _, kind, _ in [*xs, (k, dt.datetime(9000, 1, 1), -1, "end", None)]:
            if waiting and ts > first + limit:
                if fails > 2:
                    want.append((k, first, fails))
                fails, waiting = 0, False
            if kind == "fail":
                if first is None:
                    first, waiting = ts, True
                fails += 1
            else:
                first, fails, waiting = None, 0, False
    assert sorted(map(str, got)) == sorted(map(str, want)) and want
