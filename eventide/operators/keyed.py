"""Ordered per-key scans that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts every row of a key into
one task.  The reference's keyed state (previous value, running sums, list
state) is a per-key scan, and one key may carry a third of all rows, so the
scans here partition by ``(key, time bucket)`` instead and stitch bucket
boundaries together with small side tables:

* ``keyed_shift`` - exact ``lead``/``lag`` across buckets: the first ``n``
  rows of every following bucket are copied in as ghost rows.
* ``keyed_prefix`` - exact running aggregates: in-bucket running value plus
  the aggregate of all earlier buckets (a table of one row per key-bucket).

Bucket width only changes parallelism, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKET = "1 day"
_B = "_kb"  # bucket column
_G = "_ghost"


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def with_bucket(df: DataFrame, ts: str, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Epoch-aligned time bucket (monotone in ``ts``); an existing bucket
    column (from an upstream keyed scan) is kept, so the next window reuses
    the (key, bucket) partitioning instead of shuffling again."""
    if _B in df.columns:
        return df
    return df.withColumn(_B, bucket_index(F.col(ts), bucket))


_NULL_BUCKET = -(2**63)  # rows without a time: one bucket, ordered first (ASC NULLS FIRST)


def bucket_index(ts: Column, bucket: str) -> Column:
    """Epoch-aligned bucket number (never null, so bucket joins are plain
    equi-joins)."""
    us = _seconds(bucket) * 1_000_000
    micros = F.unix_micros(ts.cast("timestamp"))
    start = micros - F.pmod(micros, F.lit(us))  # an exact multiple of the width
    return F.coalesce((start / F.lit(us)).cast("long"), F.lit(_NULL_BUCKET).cast("long"))


def bucket_start(ts: Column, bucket: str) -> Column:
    """Epoch-aligned bucket start by arithmetic (a null time stays a row in a
    null bucket; ``F.window`` would filter it out)."""
    us = _seconds(bucket) * 1_000_000
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(us))).cast("timestamp_ntz")


def with_key_surrogates(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Non-null stand-ins for the keys: (coalesce(k, zero), isnull(k)).  Scans
    and their side-table joins partition and join on these, so a null key is
    a group of its own and every step shares one partitioning."""
    cols = []
    for k in keys:
        kn, ki = f"_kn_{k}", f"_ki_{k}"
        if kn not in df.columns:
            dt = df.schema[k].dataType
            zero = F.lit("") if isinstance(dt, T.StringType) else (
                F.lit(0).cast(dt) if isinstance(dt, T.NumericType) else None)
            filled = F.coalesce(F.col(k), zero) if zero is not None else F.coalesce(F.col(k).cast("string"), F.lit(""))
            df = df.withColumn(kn, filled).withColumn(ki, F.col(k).isNull())
        cols += [kn, ki]
    return df, cols


def drop_key_surrogates(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_kn_") or c.startswith("_ki_")])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null key matches a null key (a null key
    is a group of its own, as in ``groupBy``/``partitionBy``)."""
    r = right
    for k in keys:
        r = r.withColumnRenamed(k, f"_r_{k}")
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def keyed_shift(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    n: int = 1,
    direction: str = "lead",
    prefix: str | None = None,
    bucket: str = DEFAULT_BUCKET,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add ``{prefix}{v}_{j}`` = value of ``v`` ``j`` rows ahead (``lead``) or
    behind (``lag``) within the key, ordered by ``order`` (first column is the
    event time), for j = 1..n.  Equal to a global per-key lead/lag."""
    keys = _names(key)
    order = list(order)
    values = list(values)
    prefix = prefix if prefix is not None else f"{direction}_"
    fwd = direction == "lead"
    ts = order[0]
    carried = list(dict.fromkeys(order + values))

    def ordering(cols):
        return [F.col(c).asc_nulls_first() if fwd else F.col(c).desc_nulls_last() for c in cols]

    base, pk = with_key_surrogates(with_bucket(df, ts, bucket), keys)
    # first n rows of every (key, bucket) in scan direction; the row_number
    # filter becomes a partial group limit before the shuffle
    w_b = Window.partitionBy(*pk, _B).orderBy(*ordering(order))
    heads = (
        base.select(*pk, _B, *carried)
        .withColumn("_rn", F.row_number().over(w_b))
        .where(F.col("_rn") <= n)
    )
    # over the small head table: the n heads following the last head of a
    # bucket are exactly the n rows following that bucket
    w_h = Window.partitionBy(*pk).orderBy(*ordering([_B] + order))
    nxt = F.array(*[F.lead(F.struct(*carried), j).over(w_h) for j in range(1, n + 1)])
    ghosts = (
        heads.withColumn("_next_rn", F.lead("_rn").over(w_h))
        .withColumn("_g", nxt)
        # last head of its bucket: the next head (if any) opens a new bucket
        .where(F.col("_next_rn").isNull() | (F.col("_next_rn") == 1))
        .select(*pk, _B, F.explode("_g").alias("_r"))
        .where(F.col("_r").isNotNull())
        .select(*pk, _B, *[F.col(f"_r.{c}").alias(c) for c in carried])
        .withColumn(_G, F.lit(True))
    )
    real = base.withColumn(_G, F.lit(False))
    other = [c for c in real.columns if c not in set(pk + [_B, _G] + carried)]
    for c in other:
        ghosts = ghosts.withColumn(c, F.lit(None).cast(real.schema[c].dataType))
    both = real.unionByName(ghosts)
    w = Window.partitionBy(*pk, _B).orderBy(*ordering(order))
    out = both
    for j in range(1, n + 1):
        for v in values:
            out = out.withColumn(f"{prefix}{v}_{j}" if n > 1 else f"{prefix}{v}", F.lead(v, j).over(w))
    out = out.where(~F.col(_G)).drop(_G)
    return out if keep_bucket else drop_key_surrogates(out.drop(_B))


def keyed_prefix(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    agg: str = "sum",
    bucket: str = DEFAULT_BUCKET,
    exclusive: bool = False,
    keep_bucket: bool = False,
) -> DataFrame:
    """Running ``agg`` (sum, min, max, count) of ``value`` per key in ``order``,
    including the current row (or excluding it when ``exclusive``)."""
    return keyed_prefixes(df, key, order, [(value, out, agg)], bucket, exclusive, keep_bucket)


_FN = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}


def keyed_prefixes(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    specs: Sequence[tuple[Column, str, str]],
    bucket: str = DEFAULT_BUCKET,
    exclusive: bool = False,
    keep_bucket: bool = False,
) -> DataFrame:
    """Several running aggregates ``(value, out, agg)`` in one scan: one
    in-bucket window pass, one per-bucket aggregate, one offsets join."""
    keys = _names(key)
    order = list(order)
    base, pk = with_key_surrogates(with_bucket(df, order[0], bucket), keys)
    for i, (value, _, _) in enumerate(specs):
        base = base.withColumn(f"_v{i}", value)
    hi = -1 if exclusive else 0
    w_in = Window.partitionBy(*pk, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    local = base
    for i, (_, _, agg) in enumerate(specs):
        local = local.withColumn(f"_l{i}", _FN[agg](f"_v{i}").over(w_in))
    per_bucket = base.groupBy(*pk, _B).agg(*[_FN[agg](f"_v{i}").alias(f"_bt{i}") for i, (_, _, agg) in enumerate(specs)])
    w_k = Window.partitionBy(*pk).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *pk, _B, *[_MERGE[agg](f"_bt{i}").over(w_k).alias(f"_o{i}") for i, (_, _, agg) in enumerate(specs)]
    )
    res = local.join(offsets, on=pk + [_B], how="inner")
    for i, (_, out, agg) in enumerate(specs):
        off, loc = F.col(f"_o{i}"), F.col(f"_l{i}")
        if agg in ("sum", "count"):
            combined = F.coalesce(off, F.lit(0)) + F.coalesce(loc, F.lit(0))
            if agg == "sum":
                combined = F.when(off.isNull() & loc.isNull(), F.lit(None)).otherwise(combined)
        elif agg == "min":
            combined = F.least(off, loc)
        else:
            combined = F.greatest(off, loc)
        res = res.withColumn(out, combined).drop(f"_v{i}", f"_l{i}", f"_o{i}")
    return res if keep_bucket else drop_key_surrogates(res.drop(_B))


def keyed_positions(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], out: str, bucket: str = DEFAULT_BUCKET
) -> DataFrame:
    """Appended-list state in row form: ``out`` is a row's place (from 1) in
    the list of its key, in ``order``; ties in ``order`` are broken at will."""
    return keyed_prefix(df, key, order, F.lit(1), out, agg="count", bucket=bucket)


def _seconds(d: str) -> int:
    n, unit = d.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def keyed_range_list(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    value: str,
    lookback: str,
    out: str,
    bucket: str | None = None,
) -> DataFrame:
    """``collect_list(value)`` over the key's rows with time in
    [ts - lookback, ts], in time order.  Rows are scanned per (key, bucket);
    each row is also copied, as context only, into the following buckets its
    time range reaches (ceil(lookback / bucket) copies)."""
    keys = _names(key)
    bucket = bucket or lookback
    copies = -(-_seconds(lookback) // _seconds(bucket))
    step = F.expr(f"INTERVAL {bucket}")
    b = bucket_start(F.col(ts), bucket)
    # each row once as itself (k = 0) and as context of the next buckets
    both = (
        df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(copies))))
        .withColumn(_B, b + step * F.col("_k"))
        .withColumn(_G, F.col("_k") > 0)
        .drop("_k")
    )
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(*keys, _B).orderBy(micros).rangeBetween(-_seconds(lookback) * 1_000_000, 0)
    return both.withColumn(out, F.collect_list(value).over(w)).where(~F.col(_G)).drop(_B, _G)
