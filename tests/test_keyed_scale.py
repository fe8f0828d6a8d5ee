"""Bucketed per-key scans equal plain per-key windows, also when one key
holds a third of the rows (a hot key derived from the events table)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators.keyed import keyed_prefix, keyed_range_list, keyed_shift
from eventide.operators.sequences import login_failures, rising_runs, strict_sequence

from conftest import SF001


@pytest.fixture(scope="module")
def hot(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    # every third event is re-keyed to user 0: one key with a third of all rows
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))).cache()


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("direction", ["lead", "lag"])
@pytest.mark.parametrize("n", [1, 3])
def test_keyed_shift_equals_window(spark, hot, direction, n):
    got = keyed_shift(hot, "user_id", ["ts", "event_id"], ["value"], n=n, direction=direction, bucket="2 hours")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    fn = F.lead if direction == "lead" else F.lag
    exp = hot
    for j in range(1, n + 1):
        exp = exp.withColumn(f"{direction}_value_{j}" if n > 1 else f"{direction}_value", fn("value", j).over(w))
    same(got.select(*exp.columns), exp)


@pytest.mark.parametrize("agg", ["sum", "min", "max", "count"])
def test_keyed_prefix_equals_window(spark, hot, agg):
    v = F.col("value").cast("decimal(18,2)")
    got = keyed_prefix(hot, "user_id", ["ts", "event_id"], v, "r", agg=agg, bucket="6 hours")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    fn = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[agg]
    exp = hot.withColumn("r", fn(v).over(w))
    same(got.select(*exp.columns), exp)


def test_keyed_range_list_smaller_buckets(spark, hot):
    got = keyed_range_list(hot, "user_id", "ts", "event_type", "1 day", "l", bucket="6 hours")
    exp = keyed_range_list(hot, "user_id", "ts", "event_type", "1 day", "l", bucket="3650 days")
    same(got.select("event_id", "l"), exp.select("event_id", "l"))


def test_sequences_independent_of_bucket(spark, hot):
    a = strict_sequence(hot, "user_id", "event_type", ["error", "error"], "1 day", bucket="1 hour")
    b = strict_sequence(hot, "user_id", "event_type", ["error", "error"], "1 day", bucket="3650 days")
    same(a, b)
    logins = hot.where(F.col("event_type").isin("error", "signup")).withColumn(
        "event_type", F.when(F.col("event_type") == "error", "fail").otherwise("success")
    )
    same(login_failures(logins, limit="2 days", bucket="3 hours"), login_failures(logins, limit="2 days", bucket="3650 days"))
    s = hot.withColumnRenamed("value", "temperature")
    same(rising_runs(s, "user_id", "temperature", "6 hours", bucket="2 hours"),
         rising_runs(s, "user_id", "temperature", "6 hours", bucket="3650 days"))


def test_list_positions_of_a_split_hot_key(spark, hot):
    from eventide.operators.keyed import keyed_positions

    cols = ["user_id", "event_id", "pos"]
    same(keyed_positions(hot, "user_id", ["ts", "event_id"], "pos", bucket="6 hours").select(*cols),
         keyed_positions(hot, "user_id", ["ts", "event_id"], "pos", bucket="3650 days").select(*cols))
