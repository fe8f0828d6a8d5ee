"""The window-function forms of the reference's keyed programs against direct
simulations of those programs (per key, rows in time order, event-time
timers that fire once the watermark - the largest time seen - passes them,
and at the end of input), on random event lists."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventide.operators.joins import gated_forward, timed_out
from eventide.operators.sequences import followed_within, login_failures, strict_sequence

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))


def at(s):
    return T0 + dt.timedelta(seconds=s)


def events(types):
    # (key, second, type); seconds strictly increase per list so order is total
    return st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4), st.sampled_from(types)), max_size=30).map(
        lambda xs: [(k, sum(x[1] for x in xs[: i + 1]) + i, t) for i, (k, _, t) in enumerate(xs)]
    )


def frame(spark, rows):
    data = [(k, at(s), i, t) for i, (k, s, t) in enumerate(rows)]
    return spark.createDataFrame(data, "user_id long, ts timestamp_ntz, event_id long, event_type string")


def simulate_login(rows, limit, more_than):
    """The reference's keyed process function with event-time timers."""
    out, st_ = [], {}
    timers = []  # (time, key)

    def fire_until(t):
        for tt, k in sorted(x for x in timers if x[0] < t):
            timers.remove((tt, k))
            s = st_[k]
            if s["pending"] and s["timer"] == tt:
                if len(s["fails"]) > more_than:
                    out.append((k, tt - limit, len(s["fails"])))
                s["fails"], s["pending"] = [], False

    for k, s_, t in rows:
        fire_until(s_)  # watermark passes every timer before a later row
        s = st_.setdefault(k, {"fails": [], "timer": None, "pending": False})
        if t == "fail":
            s["fails"].append(s_)
            if s["timer"] is None:
                s["timer"], s["pending"] = s_ + limit, True
                timers.append((s_ + limit, k))
        else:
            s["fails"], s["timer"], s["pending"] = [], None, False
    fire_until(float("inf"))
    return sorted(out)


@SETTINGS
@given(rows=events(["fail", "fail", "success"]), limit=st.integers(1, 8))
def test_login_failures_match_the_timer_program(spark, rows, limit):
    got = login_failures(frame(spark, rows), "user_id", f"{limit} seconds", 2, bucket="5 seconds")
    got = sorted((r.user_id, int((r.first_fail - T0).total_seconds()), r.fails) for r in got.collect())
    assert got == simulate_login(rows, limit, 2)


def simulate_order_timeout(rows, limit):
    """A create finds no state: it is stored and arms create + limit; any
    other event overwrites the state.  At the timer a state that still is the
    create alerts; the state is cleared."""
    out, state, timers = [], {}, []

    def fire_until(t):
        for tt, k, ev in sorted(x for x in timers if x[0] < t):
            timers.remove((tt, k, ev))
            if state.pop(k, None) == "create":
                out.append(ev)

    for k, s_, t, ev in rows:
        fire_until(s_)
        if t != "create":
            state[k] = t
        elif k not in state:
            state[k] = t
            timers.append((s_ + limit, k, ev))
    fire_until(float("inf"))
    return sorted(out)


@SETTINGS
@given(rows=events(["create", "pay", "pay"]), limit=st.integers(1, 8))
def test_order_timeout_matches_the_timer_program(spark, rows, limit):
    # one create for each order: later ones of a key are left out
    seen = set()
    rows = [r for r in rows if r[2] != "create" or not (r[0] in seen or seen.add(r[0]))]
    keyed = [(k, s_, t, i) for i, (k, s_, t) in enumerate(rows)]
    df = frame(spark, rows).withColumnRenamed("user_id", "order_id")
    c = df.where("event_type = 'create'")
    p = df.where("event_type = 'pay'")
    got = sorted(r.event_id for r in timed_out(c, p, "order_id", "ts", "ts", f"{limit} seconds").collect())
    assert got == simulate_order_timeout(keyed, limit)


def brute_sequence(rows, steps, within):
    by_key = {}
    for i, (k, s_, t) in enumerate(rows):
        by_key.setdefault(k, []).append((s_, i, t))
    out = []
    for k, xs in by_key.items():
        for j in range(len(xs) - len(steps) + 1):
            win = xs[j : j + len(steps)]
            if [w[2] for w in win] == steps and win[-1][0] - win[0][0] < within:
                out.append(tuple(w[1] for w in win))
    return sorted(out)


@SETTINGS
@given(rows=events(["fail", "fail", "ok"]), within=st.integers(1, 12))
def test_strict_sequence_matches_brute_force(spark, rows, within):
    got = strict_sequence(frame(spark, rows), "user_id", "event_type", ["fail"] * 3, f"{within} seconds", bucket="4 seconds")
    got = sorted((r.event_id_1, r.event_id_2, r.event_id_3) for r in got.collect())
    assert got == brute_sequence(rows, ["fail"] * 3, within)


@SETTINGS
@given(rows=events(["create", "pay", "other"]), limit=st.integers(1, 8))
def test_two_step_timeout_matches_brute_force(spark, rows, limit):
    got = followed_within(frame(spark, rows), "user_id", "event_type", "create", "pay", f"{limit} seconds", bucket="3 seconds")
    got = sorted((r.event_id, r.outcome) for r in got.collect())
    by_key = {}
    for i, (k, s_, t) in enumerate(rows):
        by_key.setdefault(k, []).append((s_, i, t))
    exp = []
    for xs in by_key.values():
        for j, (s_, i, t) in enumerate(xs):
            if t != "create":
                continue
            nxt = xs[j + 1] if j + 1 < len(xs) else None
            if nxt is None or nxt[0] >= s_ + limit:
                exp.append((i, "timeout"))
            elif nxt[2] == "pay":
                exp.append((i, "matched"))
    assert got == sorted(exp)


@SETTINGS
@given(rows=events(["gate", "row", "row"]), dur=st.integers(1, 10), bucket=st.sampled_from(["2 seconds", "1 hour"]))
def test_gated_forward_matches_brute_force(spark, rows, dur, bucket):
    df = frame(spark, rows)
    gates = df.where("event_type = 'gate'").select("user_id", "ts")
    got = sorted(r.event_id for r in gated_forward(df, gates, "user_id", "ts", f"{dur} seconds", bucket=bucket).collect())
    exp = sorted(
        i for i, (k, s_, _) in enumerate(rows)
        if any(k2 == k and t2 == "gate" and g <= s_ < g + dur for (k2, g, t2) in rows)
    )
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from(["a", "b"]))), max_size=12))
def test_self_left_join_count_matches_the_join(spark, rows):
    from eventide.operators.joins import self_left_join_count

    df = spark.createDataFrame(rows, "item long, beh string")
    counts = self_left_join_count(df, "item", "beh", 3, "cnt")
    assert counts.schema["cnt"].dataType.simpleString() == "decimal(38,0)"
    got = sorted(map(tuple, counts.withColumn("cnt", counts["cnt"].cast("long")).collect()), key=repr)
    lit = spark.sql(
        """SELECT a.item, b.beh, count(a.item) AS cnt FROM {t} a
           LEFT JOIN {t} b ON a.item = b.item AND a.beh = b.beh
           LEFT JOIN {t} c ON a.item = c.item AND a.beh = c.beh
           GROUP BY a.item, b.beh""",
        t=df,
    )
    assert got == sorted(map(tuple, lit.collect()), key=repr)


def simulate_rising(rows, dur):
    """First rise after a fall (or the first reading) arms a timer at +dur;
    a fall disarms; equal values keep it; after an alert the next rise arms
    another."""
    out, st_ = [], {}
    timers = []

    def fire_until(t):
        for tt, k in sorted(x for x in timers if x[0] < t):
            timers.remove((tt, k))
            s = st_[k]
            if s["armed"] is not None and s["armed"] + dur == tt:
                out.append((k, s["armed"]))
                s["armed"] = None

    for k, s_, v in rows:
        fire_until(s_)
        s = st_.setdefault(k, {"prev": None, "armed": None})
        prev = s["prev"]
        s["prev"] = v
        if prev is None or v < prev:  # new run
            s["armed"] = None
        elif v > prev and s["armed"] is None:
            s["armed"] = s_
            timers.append((s_ + dur, k))
    fire_until(float("inf"))
    return sorted(out)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 3)), max_size=30), dur=st.integers(1, 6))
def test_rising_runs_match_the_timer_program(spark, rows, dur):
    from eventide.operators.sequences import rising_runs

    timed = [(k, sum(x[1] for x in rows[: i + 1]) + i, v) for i, (k, _, v) in enumerate(rows)]
    df = spark.createDataFrame(
        [(k, at(s_), i, float(v)) for i, (k, s_, v) in enumerate(timed)], "user_id long, ts timestamp_ntz, event_id long, temperature double"
    )
    got = rising_runs(df, "user_id", "temperature", f"{dur} seconds", bucket="3 seconds")
    got = sorted((r.user_id, int((r.armed - T0).total_seconds())) for r in got.collect())
    assert got == simulate_rising(timed, dur)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 100), st.integers(0, 30)), max_size=30))
def test_late_split_matches_micro_batch_watermarks(spark, rows):
    from eventide.operators.late import split_late_records

    # (event second, arrival delay); micro-batch = arrival in 10 s slices
    data = [(i, at(s_), at(s_ + d)) for i, (s_, d) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, arrival timestamp_ntz")
    got = sorted((r.event_id, r.tag) for r in split_late_records(df, "ts", "arrival", "10 seconds").collect())
    batches = {}
    for i, (s_, d) in enumerate(rows):
        batches.setdefault((s_ + d) // 10, []).append((i, s_))
    exp, wm = [], None
    for b in sorted(batches):
        exp += [(i, "late" if wm is not None and s_ < wm else "main") for i, s_ in batches[b]]
        mx = max(s_ for _, s_ in batches[b])
        wm = mx if wm is None else max(wm, mx)
    assert got == sorted(exp)


STREAM_SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@STREAM_SETTINGS
@given(rows=events(["fail", "fail", "success"]).filter(lambda r: len(r) >= 3), limit=st.integers(1, 8))
def test_stream_login_timer_matches_the_timer_program(spark, rows, limit):
    from pyspark.sql import functions as F

    from eventide.streaming.sinks import run_available
    from eventide.streaming.sources import dir_stream, new_stream_dirs, run_in_slices, to_event_time
    from eventide.streaming.state import login_fail_alerts

    df = frame(spark, rows)
    dirs = new_stream_dirs(spark, "t-login")
    cuts = sorted({at(rows[len(rows) // 3][1]), at(rows[2 * len(rows) // 3][1])})
    src = dir_stream(spark, f"{dirs['input']}/slice-*", df.schema, max_files=None)
    alerts = login_fail_alerts(to_event_time(src).withWatermark("ts", "0 seconds"), limit, 2)
    w = alerts.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append")
    run_in_slices(df, "ts", cuts, dirs["input"], lambda: run_available(w, dirs["checkpoint"]))
    try:
        out = spark.read.parquet(dirs["output"]).select("user_id", F.col("first_fail").cast("timestamp_ntz").alias("f"), "fails")
        got = sorted((r.user_id, int((r.f - T0).total_seconds()), r.fails) for r in out.collect())
    except Exception:  # no output file when nothing fired
        got = []
    last = max(s for _, s, _ in rows)
    exp = [a for a in simulate_login(rows, limit, 2) if a[1] + limit < last]
    assert got == exp


@STREAM_SETTINGS
@given(rows=events(["create", "pay", "other"]).filter(lambda r: len(r) >= 3), limit=st.integers(1, 8))
def test_stream_two_step_matches_brute_force(spark, rows, limit):
    from pyspark.sql import functions as F

    from eventide.streaming.sinks import run_available
    from eventide.streaming.sources import dir_stream, new_stream_dirs, run_in_slices, to_event_time
    from eventide.streaming.state import two_step_with_timeout

    df = frame(spark, rows)
    dirs = new_stream_dirs(spark, "t-seq2")
    cuts = sorted({at(rows[len(rows) // 2][1])})
    src = dir_stream(spark, f"{dirs['input']}/slice-*", df.schema, max_files=None)
    res = two_step_with_timeout(to_event_time(src).withWatermark("ts", "0 seconds"), "event_type", "create", "pay", limit)
    w = res.writeStream.format("parquet").option("path", dirs["output"]).outputMode("append")
    run_in_slices(df, "ts", cuts, dirs["input"], lambda: run_available(w, dirs["checkpoint"]))
    try:
        got = sorted((r.event_id, r.outcome) for r in spark.read.parquet(dirs["output"]).collect())
    except Exception:
        got = []
    last = max(s for _, s, _ in rows)
    by_key = {}
    for i, (k, s_, t) in enumerate(rows):
        by_key.setdefault(k, []).append((s_, i, t))
    exp = []
    for xs in by_key.values():
        for j, (s_, i, t) in enumerate(xs):
            if t != "create":
                continue
            nxt = xs[j + 1] if j + 1 < len(xs) else None
            if nxt is None:
                if s_ + limit < last:  # the final watermark passed the deadline
                    exp.append((i, "timeout"))
            elif nxt[0] >= s_ + limit:
                exp.append((i, "timeout"))
            elif nxt[2] == "pay":
                exp.append((i, "matched"))
    assert got == sorted(exp)
