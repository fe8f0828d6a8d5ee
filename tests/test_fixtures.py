"""The reference's inline fixtures and the boundary cases of FIXTURES.md,
through the library operators."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.functions.hashing import string_hash
from eventide.functions.udfs import register_sql_functions
from eventide.operators.joins import gated_forward, reconcile, timed_out
from eventide.operators.keyed import keyed_prefix, keyed_range_list
from eventide.operators.late import split_late_records
from eventide.operators.ranking import top_n_per_group
from eventide.operators.sequences import followed_within, login_failures, strict_sequence, value_jumps
from eventide.operators.transforms import connect_comap, rich_map, side_outputs, split_words
from eventide.operators.windows import hashed_bitmap_distinct, sliding_count, tumbling
from eventide.sources.text import parse_behavior_csv, reject_rows

T0 = dt.datetime(2024, 1, 1)


def t(s, ms=0):
    return T0 + dt.timedelta(seconds=s, milliseconds=ms)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_rolling_sum_keeps_first_row_fields(spark):
    data = [(1, 2, 2, t(0), 0), (2, 3, 1, t(1), 1), (2, 2, 4, t(2), 2), (1, 5, 3, t(3), 3)]
    df = spark.createDataFrame(data, "f0 long, f1 long, f2 long, ts timestamp_ntz, event_id long")
    first = df.groupBy("f0").agg(F.min_by("f2", F.struct("ts", "event_id")).alias("f2"))
    out = keyed_prefix(df.drop("f2"), "f0", ["ts", "event_id"], F.col("f1"), "s").join(first, "f0")
    assert rows(out, "event_id", "f0", "s", "f2") == [(0, 1, 2, 2), (1, 2, 3, 1), (2, 2, 5, 1), (3, 1, 7, 2)]


def test_rolling_list_concat(spark):
    data = [("en", "tea", t(0), 0), ("fr", "vin", t(1), 1), ("en", "cake", t(2), 2), ("fr", "je", t(3), 3)]
    df = spark.createDataFrame(data, "k string, w string, ts timestamp_ntz, event_id long")
    out = keyed_range_list(df, "k", "ts", "w", "365 days", "l")
    assert rows(out, "event_id", "k", "l") == [
        (0, "en", ["tea"]), (1, "fr", ["vin"]), (2, "en", ["tea", "cake"]), (3, "fr", ["vin", "je"])
    ]


def test_union_is_a_bag(spark):
    a = spark.createDataFrame([(1,), (4,)], "x long")
    b = spark.createDataFrame([(2,), (5,)], "x long")
    c = spark.createDataFrame([(3,), (6,), (6,)], "x long")
    assert sorted(r.x for r in a.union(b).union(c).collect()) == [1, 2, 3, 4, 5, 6, 6]


def test_connect_comap(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, s string")
    b = spark.createDataFrame([(1, 1), (1, 2)], "k long, v long")
    out = connect_comap(
        a, b, F.concat(F.col("s"), F.lit(" from map1")), F.concat(F.col("v").cast("string"), F.lit(" from map2"))
    )
    assert sorted(r.msg for r in out.collect()) == ["1 from map2", "2 from map2", "a from map1", "b from map1"]


def test_rich_map_open_close(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x long")
    out = rich_map(df, lambda b, ctx: b.assign(x=b.x + ctx), "x long", open_fn=lambda: 1)
    assert sorted(r.x for r in out.collect()) == [2, 3, 4]


def _logins(spark, data):
    return spark.createDataFrame(data, "user_id long, ip string, event_type string, ts timestamp_ntz, event_id long")


def test_three_fails_strict_sequence(spark):
    data = [
        (1, "192.168.0.1", "fail", t(1), 0),
        (1, "192.168.0.2", "fail", t(2), 1),
        (1, "192.168.0.3", "fail", t(3), 2),
        (2, "192.168.10.10", "success", t(4), 3),
    ]
    out = strict_sequence(_logins(spark, data), "user_id", "event_type", ["fail"] * 3, "10 seconds", carry=["ip"])
    assert rows(out, "user_id", "ip_1", "ip_2", "ip_3") == [(1, "192.168.0.1", "192.168.0.2", "192.168.0.3")]


def test_four_fails_give_two_overlapping_matches(spark):
    data = [(1, "x", "fail", t(i), i) for i in range(4)]
    out = strict_sequence(_logins(spark, data), "user_id", "event_type", ["fail"] * 3, "10 seconds")
    assert rows(out, "event_id_1", "event_id_3") == [(0, 2), (1, 3)]


def test_sequence_within_is_strict(spark):
    data = [(1, "x", "fail", t(0), 0), (1, "x", "fail", t(5), 1), (1, "x", "fail", t(10), 2)]
    assert strict_sequence(_logins(spark, data), "user_id", "event_type", ["fail"] * 3, "10 seconds").count() == 0


def test_login_failure_timer(spark):
    data = [(1, "a", "fail", t(1), 0), (1, "b", "fail", t(3), 1), (1, "c", "fail", t(4), 2)]
    out = login_failures(_logins(spark, data), limit="5 seconds")
    assert rows(out, "user_id", "fails") == [(1, 3)]


def test_login_failure_success_clears(spark):
    data = [(1, "a", "fail", t(1), 0), (1, "s", "success", t(2), 1), (1, "b", "fail", t(3), 2), (1, "c", "fail", t(4), 3)]
    assert login_failures(_logins(spark, data), limit="5 seconds").count() == 0


def test_login_failure_fails_spanning_exactly_the_limit(spark):
    # third fail exactly at t0 + limit still counts (timer fires after it)
    data = [(1, "a", "fail", t(0), 0), (1, "b", "fail", t(2), 1), (1, "c", "fail", t(5), 2)]
    assert rows(login_failures(_logins(spark, data), limit="5 seconds"), "fails") == [(3,)]


def _orders(spark, data):
    return spark.createDataFrame(data, "order_id long, event_type string, ts timestamp_ntz, event_id long")


def test_order_timeout_timer_and_sequence(spark):
    ev = _orders(spark, [(1, "create", t(1), 0), (2, "create", t(2), 1), (2, "pay", t(3), 2)])
    creates = ev.where("event_type = 'create'")
    pays = ev.where("event_type = 'pay'")
    assert rows(timed_out(creates, pays, "order_id", "ts", "ts", "5 seconds"), "order_id") == [(1,)]
    seq = followed_within(ev, "order_id", "event_type", "create", "pay", "5 seconds")
    assert rows(seq, "order_id", "outcome") == [(1, "timeout"), (2, "matched")]


def test_payment_before_the_order(spark):
    ev = _orders(spark, [(1, "pay", t(0), 0), (1, "create", t(3), 1), (2, "create", t(3), 2)])
    creates, pays = ev.where("event_type = 'create'"), ev.where("event_type = 'pay'")
    assert rows(timed_out(creates, pays, "order_id", "ts", "ts", "1 seconds"), "order_id") == [(2,)]


def test_payment_exactly_at_limit(spark):
    ev = _orders(spark, [(1, "create", t(0), 0), (1, "pay", t(5), 1)])
    creates, pays = ev.where("event_type = 'create'"), ev.where("event_type = 'pay'")
    assert timed_out(creates, pays, "order_id", "ts", "ts", "5 seconds").count() == 0  # timer form: in
    seq = followed_within(ev, "order_id", "event_type", "create", "pay", "5 seconds")
    assert rows(seq, "outcome") == [("timeout",)]  # sequence form: strict, out


def test_create_followed_by_create(spark):
    ev = _orders(spark, [(1, "create", t(0), 0), (1, "create", t(1), 1), (1, "pay", t(2), 2)])
    seq = followed_within(ev, "order_id", "event_type", "create", "pay", "5 seconds")
    assert rows(seq, "event_id", "outcome") == [(1, "matched")]  # the first partial match is discarded


def test_reconciliation_fixture(spark):
    p = 1558430
    orders = spark.createDataFrame(
        [(1, "create", p * 1000 + 842), (2, "create", p * 1000 + 843), (1, "pay", p * 1000 + 844),
         (2, "pay", p * 1000 + 845), (3, "create", p * 1000 + 849), (3, "pay", p * 1000 + 849)],
        "order_id long, event_type string, s long",
    ).withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    receipts = spark.createDataFrame(
        [(1, "wechat", p * 1000 + 847), (2, "alipay", p * 1000 + 848), (4, "alipay", p * 1000 + 850)],
        "order_id long, channel string, s long",
    ).withColumn("pay_ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    latest = orders.groupBy("order_id").agg(F.max("ts").alias("order_ts"))
    out = reconcile(latest, receipts.select("order_id", "pay_ts"), "order_id", "order_ts", "pay_ts")
    assert rows(out, "order_id", "tag") == [(1, "matched"), (2, "matched"), (3, "left_only"), (4, "right_only")]


def test_gated_forward_and_overlapping_gates(spark):
    readings = spark.createDataFrame(
        [(0, "sensor_2", t(0)), (1, "sensor_2", t(5)), (2, "sensor_2", t(12)), (3, "sensor_1", t(5)),
         (4, "sensor_2", t(20, 500))],
        "event_id long, id string, ts timestamp_ntz",
    )
    gates = spark.createDataFrame([("sensor_2", t(0)), ("sensor_2", t(3)), ("sensor_2", t(11))], "id string, ts timestamp_ntz")
    out = gated_forward(readings, gates, "id", "ts", "10 seconds", bucket="5 seconds")
    assert sorted(r.event_id for r in out.collect()) == [0, 1, 2, 4]


def test_hashed_distinct_fixture(spark):
    lines = spark.createDataFrame([("1,1,1,pv,1",), ("2,1,1,pv,3",), ("1,1,1,pv,10000",)], "value string")
    beh = parse_behavior_csv(lines)
    out = hashed_bitmap_distinct(beh, "ts", "60 minutes", F.col("user_id").cast("string"))
    got = {int(r.window_end.replace(tzinfo=dt.timezone.utc).timestamp() * 1000): r.n for r in out.collect()}
    assert got == {3600000: 2, 10800000: 1}


def test_string_hash(spark):
    assert spark.range(1).select(string_hash(F.lit("12")).alias("h")).first().h == 3039


def test_scalar_sql_function(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT a('dd') AS c").first().c == "dd1"


def _sensor(spark, data):
    return spark.createDataFrame(data, "user_id long, ts timestamp_ntz, event_id long, temperature double")


def test_jump_previous_zero_default(spark):
    df = _sensor(spark, [(1, t(0), 0, 2.0), (1, t(1), 1, 0.0), (1, t(2), 2, 1.5)])
    assert rows(value_jumps(df, "user_id", "temperature", 1.7), "event_id") == [(1,)]
    assert rows(value_jumps(df, "user_id", "temperature", 1.7, default_prev=0.0), "event_id") == [(0,), (1,)]


def test_side_output(spark):
    df = _sensor(spark, [(1, t(0), 0, 30.0), (1, t(1), 1, 40.0)])
    out = side_outputs(df, {"main": None, "alarm": F.col("temperature") < 32})
    assert rows(out, "tag", "event_id") == [("alarm", 0), ("main", 0), ("main", 1)]


def test_window_boundaries(spark):
    df = spark.createDataFrame([(t(0),), (t(3599),), (t(3600),)], "ts timestamp_ntz")
    out = tumbling(df, "ts", "1 hour", [], n=F.count(F.lit(1)))
    assert rows(out, "window_end", "n") == [(t(3600), 2), (t(7200), 1)]
    sl = sliding_count(df, "ts", "1 hour", "30 minutes", [], "n")
    assert rows(sl, "window_end", "n") == [(t(1800), 1), (t(3600), 2), (t(5400), 2), (t(7200), 1)]


def test_tie_at_rank_n_breaks_by_item(spark):
    df = spark.createDataFrame([(1, 5, 7), (1, 5, 3), (1, 9, 8), (1, 1, 1)], "w long, cnt long, item long")
    out = top_n_per_group(df, ["w"], [F.desc("cnt"), F.asc("item")], 2)
    assert rows(out, "rank", "item") == [(1, 8), (2, 3)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz, item_id long")
    assert sliding_count(df, "ts", "1 hour", "5 minutes", ["item_id"]).count() == 0


def test_null_key_is_its_own_group(spark):
    df = _sensor(spark, [(None, t(0), 0, 1.0), (None, t(1), 1, 100.0), (1, t(2), 2, 1.0)])
    assert rows(value_jumps(df, "user_id", "temperature", 50.0), "event_id") == [(1,)]


def test_malformed_csv_rows_are_rejected(spark):
    lines = spark.createDataFrame([("1,2,3,pv,100",), ("x,2,3,pv,100",), ("1,2",)], "value string")
    good, bad = reject_rows(parse_behavior_csv(lines), ["user_id", "item_id", "ts"])
    assert good.count() == 1 and bad.count() == 2


def test_java_split_semantics(spark):
    df = spark.createDataFrame([("a  b ",), ("   ",), ("",)], "s string")
    got = [r.w for r in df.select(split_words(F.col("s")).alias("w")).collect()]
    assert got == [["a", "", "b"], [], [""]]


def test_late_rows_around_the_watermark(spark):
    # batch 0 (arrival hour 0) sets the watermark to t(100); batch 1 holds
    # rows 1 ms below, at and 1 ms above it
    data = [(0, t(100), t(100)), (1, t(99, 999), t(3700)), (2, t(100), t(3700)), (3, t(100, 1), t(3700))]
    df = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, arrival timestamp_ntz")
    out = split_late_records(df, "ts", "arrival", "1 hour")
    assert rows(out, "event_id", "tag") == [(0, "main"), (1, "late"), (2, "main"), (3, "main")]


def test_running_count_window_is_bucketed(spark):
    df = spark.range(0, 2500).withColumnRenamed("id", "event_id")
    w = Window.partitionBy(F.floor(F.col("event_id") / 1000)).orderBy("event_id")
    out = df.select("event_id", F.row_number().over(w).alias("n"))
    assert out.where("event_id = 1999").first().n == 1000


def test_null_key_rows_are_kept_by_prefix_scans(spark):
    df = _sensor(spark, [(None, t(0), 0, 1.0), (None, t(1), 1, 2.0), (1, t(2), 2, 5.0)])
    out = keyed_prefix(df, "user_id", ["ts", "event_id"], F.col("temperature"), "s", bucket="1 second")
    assert rows(out, "event_id", "s") == [(0, 1.0), (1, 3.0), (2, 5.0)]


def test_null_event_time_rows_are_kept_by_keyed_scans(spark):
    from eventide.operators.keyed import keyed_shift

    df = _sensor(spark, [(1, None, 0, 1.0), (1, t(0), 1, 2.0), (1, t(90000), 2, 3.0)])
    out = keyed_shift(df, "user_id", ["ts", "event_id"], ["temperature"], direction="lag", bucket="1 day")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    exp = df.withColumn("lag_temperature", F.lag("temperature").over(w))
    assert rows(out, "event_id", "lag_temperature") == rows(exp, "event_id", "lag_temperature")
    assert out.count() == 3


def test_window_process_per_group_and_salted(spark):
    import pandas as pd

    from eventide.functions.udfs import each_group, window_process

    df = spark.createDataFrame([(1, "a", float(i)) for i in range(50)] + [(2, "b", 7.0)], "k long, w string, v double")

    def span(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [g.k.iloc[0]], "w": [g.w.iloc[0]], "lo": [g.v.min()], "hi": [g.v.max()]})

    schema = "k long, w string, lo double, hi double"
    plain = window_process(df, ["k", "w"], each_group(span, ["k", "w"]), schema)
    assert rows(plain, "k", "lo", "hi") == [(1, 0.0, 49.0), (2, 7.0, 7.0)]

    def part(p: pd.DataFrame) -> pd.DataFrame:
        return p.groupby(["k", "w", "_salt"], as_index=False).agg(lo=("v", "min"), hi=("v", "max"))

    def comb(p: pd.DataFrame) -> pd.DataFrame:
        return p.groupby(["k", "w"], as_index=False).agg(lo=("lo", "min"), hi=("hi", "max"))

    salted = window_process(df, ["k", "w"], part, schema, combine=comb, salt_buckets=8)
    assert rows(salted, "k", "lo", "hi") == [(1, 0.0, 49.0), (2, 7.0, 7.0)]
