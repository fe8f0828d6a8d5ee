"""Keyed state processors for Structured Streaming
(``applyInPandasWithState``).  A call has the rows of one key bucket (a hash of
the key) of a micro-batch and the bucket's state: arrays with one entry a key.
Each key is handled by itself, but a call costs milliseconds whatever it does,
so their number is that of the buckets, not of the keys.

Rows of a key inside one micro-batch are ordered by (ts, event_id) before
they are applied, so results equal the batch (window function) forms.  The
per-call memory is one bucket's rows of one micro-batch, which the source
bounds (``maxFilesPerTrigger`` / ``maxBytesPerTrigger``), and its state, which
more ``buckets`` make smaller.  Where a key may be hot, use the split forms in
``eventide.streaming.carry``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BUCKETS = 1024
NULL_BUCKET = -1  # null is a key of its own, in a bucket of its own


def _by_bucket(df: DataFrame, key: str, buckets: int) -> GroupedData:
    """``df`` grouped by key bucket; ``_key`` is the key, never null (numbers
    stay whole in pandas)."""
    bucket = F.when(F.col(key).isNull(), NULL_BUCKET).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    return df.withColumn("_bucket", bucket).withColumn("_key", F.coalesce(F.col(key).cast("long"), F.lit(0))).groupBy("_bucket")


def _rows(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(["_key", "ts", "event_id"], kind="stable")


def _us(rows: pd.DataFrame) -> np.ndarray:
    return rows["ts"].to_numpy().astype("datetime64[us]").astype("int64")


def _ends(keys: np.ndarray) -> np.ndarray:
    """Places of each key's last row; ``keys`` sorted."""
    return np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) if len(keys) else np.array([], dtype="int64")


def _held(state: GroupState) -> list:
    """The state's arrays as one tuple a key."""
    return list(zip(*state.get)) if state.exists else []


def _hold(state: GroupState, entries: list, deadlines=()) -> None:
    """Keep ``entries``, one tuple a key; called again once the watermark has
    passed the first of the deadlines (ms)."""
    if not entries:
        state.remove()
        return
    state.update(tuple(map(list, zip(*entries))))
    if deadlines:
        state.setTimeoutTimestamp(min(deadlines))


def _out(bucket: tuple, keys) -> pd.Series:
    """Key column of the output."""
    keys = list(keys)
    return pd.Series([None] * len(keys) if bucket[0] == NULL_BUCKET else keys, dtype="Int64")


# -- value state: jump alert ---------------------------------------------------

JUMP_OUT = "user_id long, ts timestamp, event_id long, last double, cur double"
JUMP_STATE = "keys array<long>, last array<double>"


def jump_alerts(df: DataFrame, threshold: float, buckets: int = BUCKETS) -> DataFrame:
    """|temperature - last| > threshold per user; no alert on the first
    reading (the state does not exist yet)."""

    def fn(bucket, pdfs, state: GroupState):
        rows = _rows(pdfs)
        if rows.empty:
            return
        last = dict(_held(state))
        keys, cur = rows["_key"].to_numpy(), rows["temperature"].to_numpy(dtype="float64")
        ends = _ends(keys)
        starts = np.append(0, ends[:-1] + 1)
        prev = np.append(np.nan, cur[:-1])
        prev[starts] = [last.get(k, np.nan) for k in keys[starts].tolist()]
        last.update(zip(keys[ends].tolist(), cur[ends].tolist()))
        _hold(state, list(last.items()))
        fired = np.abs(cur - prev) > threshold
        out = rows.loc[fired, ["ts", "event_id"]].reset_index(drop=True)
        out.insert(0, "user_id", _out(bucket, keys[fired]))
        out["last"], out["cur"] = prev[fired], cur[fired]
        yield out

    return _by_bucket(df, "user_id", buckets).applyInPandasWithState(
        fn, JUMP_OUT, JUMP_STATE, "append", GroupStateTimeout.NoTimeout
    )


# -- event-time timer: login failures ----------------------------------------------

LOGIN_OUT = "user_id long, first_fail timestamp, fails long"
LOGIN_STATE = "keys array<long>, timer_us array<long>, fails array<long>, pending array<boolean>"
NO_FAILS = (None, 0, False)


def _login_rows(ev: np.ndarray, us: np.ndarray, held: tuple, limit_us: int, more_than: int) -> tuple[tuple, list]:
    """A key's state (timer, fails, pending) after its rows, and its alerts."""
    timer_us, fails, pending = held
    out = []
    cuts = [-1, *np.flatnonzero(ev != "fail").tolist(), len(ev)]
    # runs of fails between successes, each handled with one search
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        run = us[lo + 1 : hi]
        if len(run):
            if timer_us is None:
                timer_us, pending = int(run[0]) + limit_us, True
            if pending:
                j = int(np.searchsorted(run, timer_us, side="right"))  # first fail after the timer
                if j < len(run):
                    if fails + j > more_than:
                        out.append((timer_us - limit_us, fails + j))
                    fails, pending = len(run) - j, False
                else:
                    fails += len(run)
            else:
                fails += len(run)
        if hi < len(ev):  # a success: the timer may fire first, then all is cleared
            if pending and us[hi] > timer_us and fails > more_than:
                out.append((timer_us - limit_us, fails))
            fails, timer_us, pending = 0, None, False
    return (timer_us, fails, pending), out


def login_fail_alerts(df: DataFrame, limit_s: int, more_than: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """Keyed timer rule on a stream.  The first fail after a success (or the
    start) registers an event-time timer at t0 + limit; a success clears the
    fails and deletes the timer; when the timer fires with more than
    ``more_than`` fails, alert.  The timer is registered once per segment
    between successes (its time stays set after firing).

    A timer fires inside the key's own rows as soon as a row later than it
    is applied (rows at exactly the timer time come first), and otherwise once
    the watermark passes it: with later rows of the bucket or as the bucket's
    state timeout."""
    limit_us = limit_s * 1_000_000

    def fn(bucket, pdfs, state: GroupState):
        out = []
        held = {k: tuple(s) for k, *s in _held(state)}
        rows = _rows(pdfs)
        if not rows.empty:
            keys, ev, us = rows["_key"].to_numpy(), rows["event_type"].to_numpy(dtype=object), _us(rows)
            lo = 0
            for hi in (_ends(keys) + 1).tolist():
                k = int(keys[lo])
                held[k], alerts = _login_rows(ev[lo:hi], us[lo:hi], held.get(k, NO_FAILS), limit_us, more_than)
                out += [(k, *a) for a in alerts]
                lo = hi
        wm, deadlines = state.getCurrentWatermarkMs(), []
        for k, (timer_us, fails, pending) in held.items():
            if pending and timer_us // 1000 < wm:  # the watermark has passed the timer
                if fails > more_than:
                    out.append((k, timer_us - limit_us, fails))
                held[k] = (timer_us, 0, False)
            elif pending:
                deadlines.append(timer_us // 1000)
        _hold(state, [(k, *s) for k, s in held.items() if s != NO_FAILS], deadlines)
        if out:
            res = pd.DataFrame(out, columns=["key", "first_us", "fails"])
            res["user_id"] = _out(bucket, res["key"])
            res["first_fail"] = pd.to_datetime(res["first_us"], unit="us")
            yield res[["user_id", "first_fail", "fails"]]

    return _by_bucket(df, "user_id", buckets).applyInPandasWithState(
        fn, LOGIN_OUT, LOGIN_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


# -- two-step pattern with timeout on a stream ---------------------------------------

TWO_STEP_OUT = "user_id long, event_id long, outcome string"
TWO_STEP_STATE = "keys array<long>, pending_id array<long>, pending_us array<long>"


def two_step_with_timeout(
    df: DataFrame, step_col: str, first: str, second: str, limit_s: int, buckets: int = BUCKETS
) -> DataFrame:
    """``first`` followed by ``second`` as the key's very next event within
    ``limit_s`` (strict).  A partial match ends as ``matched``, as
    ``timeout`` (the next event came too late, or the watermark passed the
    deadline with no next event), or silently when a different event comes
    first.  Pending partial matches live in keyed state with an event-time
    timeout at the first of a bucket's deadlines."""
    limit_us = limit_s * 1_000_000

    def fn(bucket, pdfs, state: GroupState):
        held = np.array(_held(state), dtype="int64").reshape(-1, 3)  # first steps pending from earlier batches
        keys, ids, us = held[:, 0], held[:, 1], held[:, 2]
        types = np.full(len(keys), first, dtype=object)
        rows = _rows(pdfs)
        if not rows.empty:
            # they come before the key's rows; the sort is stable
            keys = np.concatenate([keys, rows["_key"].to_numpy()])
            at = np.argsort(keys, kind="stable")
            keys = keys[at]
            ids = np.concatenate([ids, rows["event_id"].to_numpy().astype("int64")])[at]
            types = np.concatenate([types, rows[step_col].to_numpy(dtype=object)])[at]
            us = np.concatenate([us, _us(rows)])[at]
        # a first step is decided by the key's very next event
        starts = np.flatnonzero((types[:-1] == first) & (keys[:-1] == keys[1:]))
        late = (us[starts + 1] - us[starts]) >= limit_us
        hit = ~late & (types[starts + 1] == second)
        open_ = _ends(keys)
        open_ = open_[types[open_] == first]
        deadline = (us[open_] + limit_us) // 1000
        over = deadline < state.getCurrentWatermarkMs()  # the watermark has passed the deadline
        timeout, wait = np.concatenate([starts[late], open_[over]]), open_[~over]
        _hold(state, list(zip(keys[wait].tolist(), ids[wait].tolist(), us[wait].tolist())), deadline[~over].tolist())
        ended = np.concatenate([timeout, starts[hit]])
        if len(ended):
            outcome = ["timeout"] * len(timeout) + ["matched"] * int(hit.sum())
            yield pd.DataFrame({"user_id": _out(bucket, keys[ended]), "event_id": ids[ended], "outcome": outcome})

    return _by_bucket(df, "user_id", buckets).applyInPandasWithState(
        fn, TWO_STEP_OUT, TWO_STEP_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
