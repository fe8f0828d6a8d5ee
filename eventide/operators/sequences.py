"""Event-sequence matching and keyed timer logic, as ordered per-key scans.

Strict contiguity ("next") is a ``lead`` over *all* rows of the key,
filtered afterwards.  Every per-key scan goes through ``keyed_shift`` /
``keyed_prefix``, so a hot key is split by time bucket; per-segment values
are ordinary (partially aggregated) group-bys and many-to-one joins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.keyed import DEFAULT_BUCKET, _seconds, keyed_prefix, keyed_shift, null_safe_join
from eventide.operators.windows import interval
from eventide.session import fork_point

ORDER = ("ts", "event_id")
BITS = "_step_bits"


def step_bits(steps: Sequence[Column]) -> Column:
    """One number a row: bit j is set if the row satisfies step j."""
    if len(steps) > 62:
        raise ValueError("at most 62 steps")
    bits = [F.when(step, F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long")) for j, step in enumerate(steps)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def strict_sequence(
    df: DataFrame,
    key: str,
    step_col: str | None,
    steps: Sequence[str | Column],
    within: str,
    carry: Sequence[str] = ("event_id",),
    order: Sequence[str] = ORDER,
    bucket: str = DEFAULT_BUCKET,
) -> DataFrame:
    """Matches of ``steps`` on consecutive rows of a key (begin.next.next...),
    last minus first time strictly below ``within``; overlapping matches are
    all kept (no skip strategy).  A step is any predicate over a row's columns
    (one that is null is not satisfied), or a value of ``step_col``.  Output:
    key, ``e1..en`` of each carried column (suffixes ``_1..``) and
    ``first_ts``/``last_ts``.

    A row's predicates become bits of one number; a match has bit j in the row
    j places on, so the numbers are shifted along the key and combined."""
    n = len(steps)
    ts = order[0]
    df = df.withColumn(BITS, step_bits([F.col(step_col) == st if isinstance(st, str) else st for st in steps]))
    vals = list(dict.fromkeys([BITS, ts, *carry]))
    s = keyed_shift(df, key, order, vals, n=n - 1, direction="lead", prefix="_nx_", bucket=bucket) if n > 1 else df

    def at(v, j):
        if j == 0:
            return F.col(v)
        return F.col(f"_nx_{v}_{j}") if n > 2 else F.col(f"_nx_{v}")

    hit = reduce(lambda a, b: a.bitwiseAND(b), [F.shiftright(at(BITS, j), j) for j in range(n)]).bitwiseAND(F.lit(1).cast("long"))
    cond = (hit == 1) & (at(ts, n - 1) < at(ts, 0) + interval(within))
    out = [F.col(key)]
    for c in carry:
        out += [at(c, j).alias(f"{c}_{j + 1}") for j in range(n)]
    out += [at(ts, 0).alias("first_ts"), at(ts, n - 1).alias("last_ts")]
    return s.where(cond).select(*out)


def followed_within(
    df: DataFrame,
    key: str,
    step_col: str,
    first: str,
    second: str,
    limit: str,
    order: Sequence[str] = ORDER,
    bucket: str = DEFAULT_BUCKET,
) -> DataFrame:
    """Two-step pattern ``first`` -> next ``second`` within ``limit`` (strict),
    with timeouts: adds ``outcome`` = matched | timeout for every ``first``
    row; a different next row inside the limit discards the partial match
    (no row)."""
    ts = order[0]
    s = keyed_shift(df, key, order, [step_col, ts, "event_id"], n=1, direction="lead", prefix="_nx_", bucket=bucket)
    nts, ntype = F.col(f"_nx_{ts}"), F.col(f"_nx_{step_col}")
    inside = nts.isNotNull() & (nts < F.col(ts) + interval(limit))
    outcome = F.when(inside & (ntype == second), "matched").when(~inside, "timeout")
    return (
        s.where(F.col(step_col) == first)
        .withColumn("outcome", outcome)
        .where(F.col("outcome").isNotNull())
        .select(key, "event_id", ts, F.col("_nx_event_id").alias("next_event_id"), nts.alias("next_ts"), "outcome")
    )


def login_failures(
    logins: DataFrame,
    key: str = "user_id",
    limit: str = "5 seconds",
    more_than: int = 2,
    fail: str = "fail",
    success: str = "success",
    order: Sequence[str] = ORDER,
    bucket: str = DEFAULT_BUCKET,
) -> DataFrame:
    """Keyed timer rule: the first fail after a success (or the start) arms a
    timer at t0 + limit; a success clears fails and timer; when the timer
    fires with more than ``more_than`` fails, alert.  The timer is armed once
    per segment between successes.  Event-time reading: fails at exactly
    t0 + limit count, a success at exactly t0 + limit cancels."""
    ts = order[0]
    is_succ = (F.col("event_type") == success).cast("int")
    # one segment id per login row; the segments feed three branches
    seg = fork_point(keyed_prefix(logins, key, order, is_succ, "_seg", agg="sum", bucket=bucket))
    fails = seg.where(F.col("event_type") == fail)
    t0 = fails.groupBy(key, "_seg").agg(F.min(ts).alias("first_fail"))
    counted = (
        null_safe_join(fails, t0, [key, "_seg"])
        .where(F.col(ts) <= F.col("first_fail") + interval(limit))
        .groupBy(key, "_seg", "first_fail")
        .agg(F.count(F.lit(1)).alias("fails"))
    )
    nxt = seg.where(F.col("event_type") == success).select(
        key, (F.col("_seg") - 1).alias("_seg"), F.col(ts).alias("_next_success")
    )
    return (
        null_safe_join(counted, nxt, [key, "_seg"], "left")
        .where(
            (F.col("fails") > more_than)
            & (F.col("_next_success").isNull() | (F.col("_next_success") > F.col("first_fail") + interval(limit)))
        )
        .select(key, "first_fail", "fails")
    )


def rising_runs(
    df: DataFrame,
    key: str,
    value: str,
    duration: str,
    order: Sequence[str] = ORDER,
    zero_is_first: bool = False,
    bucket: str = DEFAULT_BUCKET,
) -> DataFrame:
    """Rising-value alert: a rise arms a timer at +duration where none is
    armed; a fall (or the first reading of a key) disarms it; equal values and
    further rises leave it.  A timer that gets past armed + duration without a
    fall gives an alert, and the next rise arms another.  ``zero_is_first``
    keeps the reference's default-value quirk (a previous value of 0.0 counts
    as no previous value).

    Only rises and the falls that end a run are kept.  Each run is read in
    time order by one task, row by row with one armed time as state, so a hot
    key is split by its runs.  Rows without a time arm nothing."""
    ts = order[0]
    s = keyed_shift(df, key, order, [value], n=1, direction="lag", prefix="_prev_", bucket=bucket)
    prev = F.col(f"_prev_{value}")
    first = prev.isNull() | (prev == 0.0) if zero_is_first else prev.isNull()
    brk = first | (F.col(value) < prev)
    s = s.select(key, *order, brk.alias("_brk"), (~brk & (F.col(value) > prev)).alias("_rise"))
    runs = keyed_prefix(s, key, order, F.col("_brk").cast("int"), "_run", bucket=bucket)
    # a break ends the run before its own
    run = F.col("_run") - F.col("_brk").cast("int")
    name = F.concat_ws(":", run.cast("string"), F.col(key).isNull().cast("string"), F.col(key).cast("string"))
    steps = runs.where((F.col("_brk") | F.col("_rise")) & F.col(ts).isNotNull()).select(
        name.alias("run"), F.col(key).alias("key"), F.col(ts).alias("ts"), F.col("_brk").alias("ends")
    )
    dealt = steps.repartition("run").sortWithinPartitions("run", "ts", "ends")
    limit = np.timedelta64(_seconds(duration), "s")
    kind = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("armed", df.schema[ts].dataType)])

    def fire(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, armed, owner = None, None, None  # the open timer, its run and the key's value
        for b in batches:
            keys, times = [], []
            columns = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.timestamp("us")).to_numpy(False), b.column(3).to_pylist()
            for run, k, t, ends in zip(*columns, strict=True):
                if run != name:
                    if armed is not None:
                        keys.append(owner)
                        times.append(armed)
                    name, armed, owner = run, None, k
                if armed is not None and t > armed + limit:
                    keys.append(owner)
                    times.append(armed)
                    armed = None
                if ends:
                    armed = None
                elif armed is None:
                    armed = t
            yield _alerts(keys, times, b)
        if armed is not None:
            yield _alerts([owner], [armed], b)

    def _alerts(keys: list, times: list, like: pa.RecordBatch) -> pa.RecordBatch:
        columns = [pa.array(keys, like.column(1).type), pa.array(times, pa.timestamp("us")).cast(like.column(2).type)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "armed"])

    return dealt.mapInArrow(fire, kind).toDF(key, "armed")


def value_jumps(
    df: DataFrame,
    key: str,
    value: str,
    threshold: float,
    default_prev: float | None = None,
    flag_all: bool = False,
    order: Sequence[str] = ORDER,
    bucket: str = DEFAULT_BUCKET,
) -> DataFrame:
    """|current - previous| > threshold per key.  ``default_prev`` = value used
    for the first reading (None: no alert on the first reading).  With
    ``flag_all`` every row is returned, (0.0, 0.0) where nothing fired."""
    s = keyed_shift(df, key, order, [value], n=1, direction="lag", prefix="_prev_", bucket=bucket)
    prev = F.col(f"_prev_{value}")
    if default_prev is not None:
        prev = F.coalesce(prev, F.lit(float(default_prev)))
    fired = F.abs(F.col(value) - prev) > threshold
    if flag_all:
        return s.select(
            key,
            *[c for c in order],
            F.when(fired, prev).otherwise(F.lit(0.0)).alias("last"),
            F.when(fired, F.col(value)).otherwise(F.lit(0.0)).alias("cur"),
        )
    return s.where(fired).select(key, *order, prev.alias("last"), F.col(value).alias("cur"))
