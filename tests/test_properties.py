"""Property tests: the bucketed per-key scans equal plain per-key window
functions on random data (duplicate times, null keys, null times, any
bucket width)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators.keyed import keyed_prefix, keyed_shift

T0 = dt.datetime(2024, 1, 1)

row = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),  # key, sometimes null
    st.one_of(st.none(), st.integers(0, 200)),  # minutes after T0, sometimes null; duplicates likely
    st.integers(-50, 50),  # value
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    data = [
        (k, None if m is None else T0 + dt.timedelta(minutes=m), i, v) for i, (k, m, v) in enumerate(rows)
    ]
    return spark.createDataFrame(data, "k long, ts timestamp_ntz, event_id long, v long")


def same(a, b):
    ra = sorted(map(tuple, a.collect()), key=repr)
    rb = sorted(map(tuple, b.collect()), key=repr)
    assert ra == rb


@SETTINGS
@given(rows=st.lists(row, min_size=0, max_size=40), n=st.integers(1, 3),
       bucket=st.sampled_from(["7 minutes", "1 hour", "1 day"]), direction=st.sampled_from(["lead", "lag"]))
def test_shift_property(spark, rows, n, bucket, direction):
    df = frame(spark, rows)
    got = keyed_shift(df, "k", ["ts", "event_id"], ["v"], n=n, direction=direction, prefix="s_", bucket=bucket)
    w = Window.partitionBy("k").orderBy("ts", "event_id")
    fn = F.lead if direction == "lead" else F.lag
    exp = df
    for j in range(1, n + 1):
        exp = exp.withColumn(f"s_v_{j}" if n > 1 else "s_v", fn("v", j).over(w))
    same(got.select(*exp.columns), exp)


@SETTINGS
@given(rows=st.lists(row, min_size=0, max_size=40), agg=st.sampled_from(["sum", "min", "max", "count"]),
       bucket=st.sampled_from(["7 minutes", "1 hour"]), exclusive=st.booleans())
def test_prefix_property(spark, rows, agg, bucket, exclusive):
    df = frame(spark, rows)
    got = keyed_prefix(df, "k", ["ts", "event_id"], F.col("v"), "r", agg=agg, bucket=bucket, exclusive=exclusive)
    hi = -1 if exclusive else 0
    w = Window.partitionBy("k").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, hi)
    fn = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[agg]
    exp = df.withColumn("r", fn("v").over(w))
    if agg == "count":
        exp = exp.withColumn("r", F.col("r").cast("long"))
        got = got.withColumn("r", F.col("r").cast("long"))
    same(got.select(*exp.columns), exp)
