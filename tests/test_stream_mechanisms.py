"""Split keyed state, the versioned table, gates with their own end, firing
logs and grids, step predicates and the salted join: small cases by hand, and
random ones against plain versions.  ``foreachBatch`` functions are called the
way a stream calls them, replays included."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventide.functions.alerts import alert_text
from eventide.operators.joins import gated_forward_until, left_join_salted
from eventide.operators.late import firing_grid, lateness_firings
from eventide.operators.sequences import strict_sequence
from eventide.operators.transforms import side_outputs, write_outputs
from eventide.operators.windows import sliding_approx_distinct, sliding_distinct
from eventide.streaming.carry import counter_writer, last_state, restored_count, sequence_writer, state_kinds_writer, state_list
from eventide.streaming.changelog import VersionedTable, top_n_writer
from eventide.streaming.late import close_firing_log, firing_log_writer

T0 = dt.datetime(2024, 1, 1)
EVENT = "user_id long, ts timestamp_ntz, event_id long, event_type string, value double"
TYPES = ["error", "a,b", "", None, "signup"]


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def events(n=400, seed=1):
    """Users 0 (a third of the rows), 1..8 and null; types with commas, empty
    and null; times rise."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        user = 0 if i % 3 == 0 else rng.choice([*range(1, 9), None])
        rows.append((user, at(i * 600 + rng.randrange(600)), i, rng.choice(TYPES), float(rng.randrange(100))))
    return rows


def slices(rows, k=4):
    size = -(-len(rows) // k)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def plain_sequences(rows, steps, within):
    by, out = defaultdict(list), []
    for r in rows:
        by[r[0]].append(r)
    for user, own in by.items():
        for i in range(len(own) - len(steps) + 1):
            run = own[i : i + len(steps)]
            if all(s(r) for s, r in zip(steps, run)) and (run[-1][1] - run[0][1]).total_seconds() < within:
                out.append((user, *(r[2] for r in run)))
    return Counter(out)


STEPS = [lambda r: r[3] == "a,b", lambda r: r[3] != "error" and r[3] is not None, lambda r: r[4] > 30]


def columns():
    return [F.col("event_type") == "a,b", F.col("event_type") != "error", F.col("value") > 30]


def test_sequence_state_over_micro_batches(spark, tmp_path):
    rows = events()
    run = sequence_writer(str(tmp_path), "user_id", columns(), "1 day", bucket="6 hours")
    for k, part in enumerate(slices(rows)):
        run(spark.createDataFrame(part, EVENT), k)
        if k == 2:  # replayed
            run(spark.createDataFrame(part, EVENT), k)
    got = spark.read.parquet(f"{tmp_path}/matches").select("user_id", "event_id_1", "event_id_2", "event_id_3").collect()
    want = plain_sequences(rows, STEPS, 86400)
    assert len(want) > 10 and Counter(map(tuple, got)) == want


@pytest.mark.parametrize("bucket", ["1 hour", "3650 days"])
def test_step_predicates(spark, bucket):
    rows = events(seed=2)
    got = strict_sequence(spark.createDataFrame(rows, EVENT), "user_id", None, columns(), "1 day", bucket=bucket)
    got = Counter(map(tuple, got.select("user_id", "event_id_1", "event_id_2", "event_id_3").collect()))
    assert got == plain_sequences(rows, STEPS, 86400)


def test_steps_may_be_values_or_predicates(spark):
    rows = events(seed=3)
    got = strict_sequence(spark.createDataFrame(rows, EVENT), "user_id", "event_type", ["error", F.col("value") > 30], "1 day")
    want = plain_sequences(rows, [lambda r: r[3] == "error", STEPS[2]], 86400)
    assert Counter(map(tuple, got.select("user_id", "event_id_1", "event_id_2").collect())) == want


def test_state_kinds_over_micro_batches(spark, tmp_path):
    rows, path = events(seed=4), str(tmp_path)
    run = state_kinds_writer(path, "user_id", F.col("event_type") == "signup", F.col("event_type"), F.col("value"), bucket="6 hours")
    for k, part in enumerate(slices(rows)):
        run(spark.createDataFrame(part, EVENT), k)
        if k in (0, 2):
            run(spark.createDataFrame(part, EVENT), k)
    lists = defaultdict(list)
    for r in rows:
        if r[3] == "signup":
            lists[r[0]].clear()
        lists[r[0]].append(r)
    values = {r.user_id: (r.n, r.max_ts, r.min_value) for r in last_state(spark, path, "values").collect()}
    assert values == {u: (len(x), max(r[1] for r in x), min(r[4] for r in x)) for u, x in lists.items()}
    counts = {(r.user_id, r.item): r.c for r in last_state(spark, path, "counts").collect()}
    assert counts == Counter((u, r[3]) for u, x in lists.items() for r in x)
    held = {(r.user_id, r.pos): (r.item, r.event_id) for r in state_list(spark, path, "user_id").collect()}
    assert held == {(u, k + 1): (r[3], r[2]) for u, x in lists.items() for k, r in enumerate(x)}
    assert max(map(len, lists.values())) > 3


def test_counter_is_restored(spark, tmp_path):
    path = str(tmp_path)
    assert restored_count(spark, path) == 0
    run = counter_writer(path)
    for k, (n, tasks) in enumerate([(100, 4), (50, 2), (50, 2), (7, 1)]):
        batch = spark.range(n).repartition(tasks)
        run(batch, min(k, 2) if k < 3 else 3)
    run(spark.range(7), 3)  # replayed
    assert restored_count(spark, path) == 100 + 50 + 50 + 7


# --- versioned table


def table_rows(table):
    df = table.read()
    return set() if df is None else set(map(tuple, df.select("w", "k", "v").collect()))


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), ["w"])
    schema = "w long, k string, v long"

    def put(batch_id, rows, touched=()):
        df = spark.createDataFrame(rows, schema)
        groups = spark.createDataFrame([(w,) for w in {r[0] for r in rows} | set(touched)], "w long")
        table.replace(df, groups, batch_id)

    assert table.read() is None and table.changes() is None
    put(0, [(1, "a", 5), (1, "b", 4), (2, "a", 1), (None, "n", 1)])
    put(1, [(1, "b", 9), (1, "c", 8)])
    want = {(1, "b", 9), (1, "c", 8), (2, "a", 1), (None, "n", 1)}
    assert table_rows(table) == want
    put(1, [(1, "b", 9), (1, "c", 8)])  # replayed
    assert table_rows(table) == want
    table.snapshot()
    # written, but not committed
    spark.createDataFrame([(1, "x", 0)], schema).write.parquet(f"{tmp_path}/rows/batch_id=2")
    spark.createDataFrame([(1,)], "w long").write.parquet(f"{tmp_path}/touched/batch_id=2")
    assert table_rows(table) == want
    put(2, [(None, "m", 2)], touched=[2])  # group 2 is empty now
    assert table_rows(table) == {(1, "b", 9), (1, "c", 8), (None, "m", 2)}
    net = table.changes().groupBy("w", "k", "v").agg(F.sum("sign").alias("s")).where("s <> 0").collect()
    assert {(r.w, r.k, r.v) for r in net} == table_rows(table) and {r.s for r in net} == {1}


def test_rows_that_leave_the_top_leave_the_table(spark, tmp_path):
    run = top_n_writer(str(tmp_path), ["w"], ["k"], [F.desc("v"), F.asc("k")], 2)
    schema = "w long, k string, v long"
    batches = [[(1, "a", 1), (1, "b", 2), (2, "z", 1)], [(1, "c", 3)], [(1, "a", 9), (2, "y", 5)]]
    for k, rows in enumerate(batches):
        run(spark.createDataFrame(rows, schema), k)
        run(spark.createDataFrame(rows, schema), k)
    got = VersionedTable(spark, f"{tmp_path}/top", ["w"]).read()
    assert {(r.w, r.k, r.v, r["rank"]) for r in got.collect()} == {(1, "a", 9, 1), (1, "c", 3, 2), (2, "y", 5, 1), (2, "z", 1, 2)}


# --- gates


@pytest.mark.parametrize("bucket", ["10 seconds", "1 day"])
def test_gates_with_their_own_end(spark, bucket):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 1, 2, None]), rng.choice([None, *map(at, range(200))]), i) for i in range(300)]
    gates = [(0, at(10), at(100)), (0, at(20), at(25)), (1, at(50), at(40)), (2, at(150), None), (None, at(0), at(500)), (2, None, at(500))]
    gates += [(1, at(t), at(t + rng.randrange(30))) for t in range(60, 200, 17)]
    got = gated_forward_until(
        spark.createDataFrame(rows, "k long, ts timestamp_ntz, i long"),
        spark.createDataFrame(gates, "k long, ts timestamp_ntz, until timestamp_ntz"),
        "k", "ts", "until", bucket,
    )
    want = {
        i for k, t, i in rows
        if k is not None and t is not None and any(g == k and a is not None and e is not None and a <= t < e for g, a, e in gates)
    }
    assert got.columns == ["k", "ts", "i"] and sorted(r.i for r in got.collect()) == sorted(want) and len(want) > 40


# --- firings


def plain_firings(rows, size, lateness, trigger, delay):
    """The windows of a micro-batch stream, batch after batch (seconds)."""
    batches, out = defaultdict(list), []
    for k, ts, arrival in rows:
        batches[arrival // trigger * trigger].append((k, ts))
    wm, seen, fired = None, Counter(), set()
    for b in sorted(batches):
        late = set()
        for k, ts in batches[b]:
            end = ts // size * size + size
            if wm is None or end + lateness > wm:
                seen[k, end] += 1
                if wm is not None and end <= wm:
                    late.add((k, end))
        top = max(ts for _, ts in batches[b]) - delay
        after = top if wm is None else max(wm, top)
        closing = {w for w in seen if w[1] <= after and w not in fired and w not in late}
        for w in closing | late:
            out.append((*w, b, seen[w], "update" if w in fired else "first"))
            fired.add(w)
        wm = after
    out += [(*w, None, n, "first") for w, n in seen.items() if w not in fired]
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_firing_log(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        ts = i * 4 + rng.randrange(4)
        rows.append((rng.choice(["x", "x", "y", "z"]), ts, ts + rng.choice([0, 0, 5, 30, 200])))
    df = spark.createDataFrame([(k, at(t), at(a)) for k, t, a in rows], "k string, ts timestamp_ntz, arrival timestamp_ntz")
    got = lateness_firings(df, "k", "ts", "arrival", "20 seconds", "60 seconds", "60 seconds", "10 seconds")
    seconds = lambda t: None if t is None else int((t - T0).total_seconds())
    got = Counter((r.k, seconds(r.window_end), seconds(r.fired_in), r.n, r.kind) for r in got.collect())
    want = plain_firings(rows, 60, 60, 20, 10)
    assert {"first", "update"} == {w[4] for w in want} and got == want


def test_firing_log_of_a_stream(spark, tmp_path):
    rng, rows, path = random.Random(9), [], str(tmp_path)
    for i in range(120):
        ts = i * 10 + rng.randrange(10)
        rows.append((rng.choice(["x", "x", "y", None]), ts, ts + rng.choice([0, 0, 30, 100, 300])))
    run = firing_log_writer(path, "k", "60 seconds", "60 seconds", delay_us=10_000_000)
    for b, start in enumerate(sorted({a // 200 for _, _, a in rows})):
        batch = spark.createDataFrame([(k, at(t)) for k, t, a in rows if a // 200 == start], "k string, ts timestamp_ntz")
        run(batch, b)
        if b == 2:
            run(batch, b)  # replayed
    close_firing_log(spark, path, "k", "60 seconds", 10_000_000)
    got = spark.read.parquet(f"{path}/firings").collect()
    got = Counter((r.k, int((r.window_end - T0).total_seconds()), r.n, r.kind) for r in got)
    want = plain_firings(rows, 60, 60, 200, 10)
    assert got == Counter((k, e, n, kind) for k, e, _, n, kind in want.elements()) and "update" in {w[4] for w in want}


def test_grid_fires_without_own_rows(spark):
    rows = [("x", 5), ("y", 12), ("y", 31), ("x", 33), ("y", 47), ("x", 70)]
    df = spark.createDataFrame([(k, at(t)) for k, t in rows], "k string, ts timestamp_ntz")
    got = firing_grid(df, "k", "ts", "60 seconds", "10 seconds")
    got = sorted((r.k, int((r.window_end - T0).total_seconds()), int((r.fire_ts - T0).total_seconds()), r.n) for r in got.collect())
    assert got == [
        ("x", 60, 10, 1), ("x", 60, 30, 1), ("x", 60, 40, 2), ("x", 60, 60, 2), ("x", 120, 120, 1),
        ("y", 60, 30, 1), ("y", 60, 40, 2), ("y", 60, 60, 3),
    ]


# --- joins, outputs, distinct counts, texts


def test_salted_left_join_is_a_left_join(spark):
    left = [(k if k % 3 else 0, None if k % 50 == 1 else k % 2, k) for k in range(3000)]
    right = [(k, b, 10 * k + b) for k in range(0, 60) for b in (0, 1)] + [(0, 0, -1), (None, 0, -2), (5, None, -3)]
    a = spark.createDataFrame(left, "x long, y long, l long")
    b = spark.createDataFrame(right, "x long, y long, r long")
    got = Counter(map(tuple, left_join_salted(a, b, ["x", "y"], hot_share=1 / 16).select("l", "r").collect()))
    want = Counter()
    for x, y, i in left:
        found = [r for p, q, r in right if y is not None and (p, q) == (x, y)]
        want.update((i, r) for r in found or [None])
    assert got == want


def test_side_outputs_read_the_parent_once(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/in")
    df = side_outputs(spark.read.parquet(f"{tmp_path}/in"), {"main": None, "low": F.col("id") < 5, "none": F.lit(None).cast("boolean")})
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    out = write_outputs(df, f"{tmp_path}/out")
    assert set(out) == {"main", "low"} and out["main"].count() == 100 and out["low"].count() == 5


def test_sliding_distinct_by_deltas(spark):
    rng = random.Random(7)
    rows = [(rng.choice([0, 0, 1, 2, None]), rng.choice("ab"), rng.randrange(-3000, 5_000_000 if i % 5 == 0 else 9000)) for i in range(400)]
    df = spark.createDataFrame([(u, k, at(t)) for u, k, t in rows], "u long, k string, ts timestamp_ntz")
    seen = defaultdict(set)
    for u, k, t in rows:
        for j in range(1, 5):
            if u is not None:
                seen[k, at((t // 300 + j) * 300)].add(u)
    want = {w: len(us) for w, us in seen.items()}
    got = sliding_distinct(df, "ts", "20 minutes", "5 minutes", "u", ["k"])
    assert {(r.k, r.window_end): r.n for r in got.collect()} == want and got.count() == len(want)
    rough = sliding_approx_distinct(df, "ts", "20 minutes", "5 minutes", "u", ["k"])
    assert {(r.k, r.window_end): r.n for r in rough.collect()} == want  # few values: the sketch is exact


def test_alert_text(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "user long, ip string, v double")
    text = alert_text("{{{user}}} from {ip}: {twice}", twice=F.col("v") * 2)
    assert df.select(text.alias("m")).first().m == "{1} from null: 5.0"
