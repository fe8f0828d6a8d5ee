"""Tumbling and sliding event-time window aggregates.

Sliding windows are computed from panes: rows are first aggregated into
slide-sized tumbling panes (partial aggregation before any shuffle), and
only the pane aggregates are replicated into the size/slide windows that
contain them.  ``F.window(ts, size, slide)`` would instead replicate every
input row size/slide times before aggregating.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.hashing import string_hash


def _dur_seconds(d: str) -> int:
    n, unit = d.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def interval(d: str) -> Column:
    return F.expr(f"INTERVAL {d}")


def window_end(ts: str, size: str) -> Column:
    return F.window(F.col(ts), size).end


def bucket_end(ts: Column, size: str) -> Column:
    """End of the epoch-aligned tumbling window of ``size`` holding ``ts``, by
    arithmetic - usable next to another window in the same aggregate."""
    us = _dur_seconds(size) * 1_000_000
    micros = F.unix_micros(ts.cast("timestamp"))
    start = micros - F.pmod(micros, F.lit(us))
    return F.timestamp_micros(start + F.lit(us)).cast("timestamp_ntz")


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """One row per (window, keys): ``window_end``, keys, named aggregates."""
    return (
        df.groupBy(F.window(F.col(ts), size).end.alias("window_end"), *keys)
        .agg(*[c.alias(n) for n, c in aggs.items()])
    )


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def pane_of(ts: str, slide: str) -> Column:
    """Start of the slide-sized pane holding ``ts``, as epoch microseconds
    (integer arithmetic: cheaper to hash and to expand than timestamps)."""
    us = _dur_seconds(slide) * 1_000_000
    m = _micros(ts)
    return m - F.pmod(m, F.lit(us))


def explode_panes(panes: DataFrame, pane: str, size: str, slide: str) -> DataFrame:
    """Replace the pane start (epoch micros) by ``_end_us``, the end of every
    window holding the pane (size/slide rows per pane)."""
    if _dur_seconds(size) % _dur_seconds(slide):
        raise ValueError("window size must be a multiple of the slide")
    k = _dur_seconds(size) // _dur_seconds(slide)
    us = _dur_seconds(slide) * 1_000_000
    return (
        panes.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(k))))
        .withColumn("_end_us", F.col(pane) + F.col("_i").cast("long") * F.lit(us))
        .drop(pane, "_i")
    )


def _end_ts() -> Column:
    return F.timestamp_micros("_end_us").cast("timestamp_ntz").alias("window_end")


def sliding_count(
    df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = (), name: str = "n"
) -> DataFrame:
    panes = df.groupBy(pane_of(ts, slide).alias("_pane"), *keys).agg(F.count(F.lit(1)).alias("_c"))
    counts = explode_panes(panes, "_pane", size, slide).groupBy("_end_us", *keys).agg(F.sum("_c").alias(name))
    return counts.select(_end_ts(), *keys, name)


def sliding_distinct(
    df: DataFrame, ts: str, size: str, slide: str, col: str, keys: Sequence[str] = (), name: str = "n"
) -> DataFrame:
    """Exact distinct count of ``col`` per sliding window, by the windows that
    a value enters and leaves.

    A value seen in a pane is in the windows that end one slide after the pane
    up to one size after it.  It enters them at the pane and leaves them when
    it is not seen again for a size: +1 and -1, at most two rows a pane however
    many windows hold it.  The deltas are summed by window end and a running
    sum over the ends, a table as long as the time span, gives the counts.
    A value has at most one row a pane when its panes are ordered."""
    slide_us, size_us = _dur_seconds(slide) * 1_000_000, _dur_seconds(size) * 1_000_000
    if size_us % slide_us:
        raise ValueError("the size must be a multiple of the slide")
    seen = df.where(F.col(col).isNotNull()).select(pane_of(ts, slide).alias("_pane"), *keys, col).distinct()
    seen = seen.withColumn("_again", F.lead("_pane").over(Window.partitionBy(*keys, col).orderBy("_pane")))
    leaves = F.least(F.col("_pane") + size_us, F.col("_again")) + slide_us  # least passes over nulls
    moves = F.array(
        F.struct((F.col("_pane") + slide_us).alias("at"), F.lit(1).alias("d")), F.struct(leaves.alias("at"), F.lit(-1).alias("d"))
    )
    deltas = seen.select(*keys, F.explode(moves).alias("m")).groupBy(*keys, F.col("m.at").alias("_at")).agg(F.sum("m.d").alias("_d"))
    # the running sum in parts of 30 days, with the sums of earlier parts carried in
    deltas = deltas.withColumn("_all", F.lit(0)).withColumn("_part", F.expr(f"_at div {30 * 86400 * 1_000_000}"))
    group = ["_all", *keys]
    in_order = Window.partitionBy(*group).orderBy("_part")
    parts = deltas.groupBy(*group, "_part").agg(F.sum("_d").alias("_sum"), F.min("_at").alias("_first"))
    parts = parts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(group)],
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_sum").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_first").over(in_order).alias("_follows"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(group)]
    in_part = Window.partitionBy(*group, "_part").orderBy("_at")
    held = deltas.join(parts, [*same, F.col("_part") == F.col("_p")]).select(
        *keys,
        "_at",
        (F.col("_before") + F.sum("_d").over(in_part.rowsBetween(Window.unboundedPreceding, 0))).alias(name),
        F.coalesce(F.lead("_at").over(in_part), F.col("_follows")).alias("_next_at"),
    )
    ends = F.explode(F.sequence(F.col("_at"), F.col("_next_at") - slide_us, F.lit(slide_us))).alias("_end_us")
    return held.where(F.col(name) > 0).select(*keys, name, ends).select(_end_ts(), *keys, name)


def sliding_approx_distinct(
    df: DataFrame, ts: str, size: str, slide: str, col: str, keys: Sequence[str] = (), name: str = "n", lg_k: int = 12
) -> DataFrame:
    """Approximate distinct count per sliding window by mergeable sketches: one
    HyperLogLog sketch of ``2 ** lg_k`` registers a pane, merged per window, so
    no row and no value is copied into windows.  The relative standard error is
    about 1.04 / 2 ** (lg_k / 2)."""
    panes = df.groupBy(pane_of(ts, slide).alias("_pane"), *keys).agg(F.hll_sketch_agg(col, lg_k).alias("_s"))
    merged = explode_panes(panes, "_pane", size, slide).groupBy("_end_us", *keys).agg(F.hll_union_agg("_s").alias("_s"))
    counts = merged.withColumn(name, F.hll_sketch_estimate("_s")).where(F.col(name) > 0)
    return counts.select(_end_ts(), *keys, name)


def hashed_bitmap_distinct(
    df: DataFrame, ts: str, size: str, value: Column, bits: int = 65536, name: str = "n"
) -> DataFrame:
    """Distinct count of ``string_hash(value) mod bits`` per tumbling window,
    kept as Spark bitmaps (32768 positions per bitmap bucket): the per-window
    state is at most ``bits`` bits, whatever the number of users."""
    pos = string_hash(value, size=bits) + F.lit(1)  # positions 1..bits
    per_bucket = df.groupBy(
        F.window(F.col(ts), size).end.alias("window_end"), F.bitmap_bucket_number(pos).alias("_bb")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(pos)).alias("_bm"))
    return per_bucket.groupBy("window_end").agg(F.sum(F.bitmap_count("_bm")).alias(name))
