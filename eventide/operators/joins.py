"""Two-input operators: reconciliation, gated forwarding, timeouts, and the
multi-way self join count."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.keyed import keyed_prefix
from eventide.operators.windows import interval


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    bound: str | None = None,
    tag: str = "tag",
) -> DataFrame:
    """Two-sided match of one pending row per key and side (full outer join on
    a unique key).  Tags: ``matched`` (both, and the right time within
    ``bound`` of the left when given), ``left_only``, ``right_only``.  With a
    bound, an out-of-bound pair is reported on both sides."""
    j = left.join(right, on=key, how="full_outer")
    both = F.col(left_ts).isNotNull() & F.col(right_ts).isNotNull()
    if bound is not None:
        both = both & (F.col(right_ts) <= F.col(left_ts) + interval(bound))
    if bound is None:
        return j.withColumn(
            tag,
            F.when(both, "matched").when(F.col(right_ts).isNull(), "left_only").otherwise("right_only"),
        )
    lo = j.where(~both & F.col(left_ts).isNotNull()).withColumn(tag, F.lit("left_only")).withColumn(right_ts, F.lit(None).cast(j.schema[right_ts].dataType))
    ro = j.where(~both & F.col(right_ts).isNotNull()).withColumn(tag, F.lit("right_only")).withColumn(left_ts, F.lit(None).cast(j.schema[left_ts].dataType))
    return j.where(both).withColumn(tag, F.lit("matched")).unionByName(lo).unionByName(ro)


def gated_forward(
    rows: DataFrame,
    gates: DataFrame,
    key: str,
    ts: str,
    duration: str,
    bucket: str = "1 day",
) -> DataFrame:
    """Rows whose key has a gate opened at g with g <= ts < g + duration
    (each row at most once, however many gates overlap).

    As-of form, no pairs: gate times are copied into every time bucket their
    open interval touches (duration/bucket + 1 copies), rows and gate copies
    are scanned per (key, bucket) in time order, and a row passes when the
    latest gate at or before it is still open.  A hot key is split by
    bucket."""
    b_rows = rows.withColumn("_b", F.window(F.col(ts), bucket).start).withColumn("_gate", F.lit(None).cast(rows.schema[ts].dataType))
    g = gates.select(F.col(key), F.col(ts).alias("_gate"))
    first_b = F.window(F.col("_gate"), bucket).start
    last_b = F.window(F.col("_gate") + interval(duration), bucket).start
    g = g.withColumn("_b", F.explode(F.sequence(first_b, last_b, interval(bucket))))
    cols = [c for c in b_rows.columns if c not in (key, "_b", "_gate")]
    g = g.select(key, "_b", "_gate", *[F.lit(None).cast(b_rows.schema[c].dataType).alias(c) for c in cols])
    g = g.withColumn(ts, F.col("_gate"))
    both = b_rows.withColumn("_is_gate", F.lit(0)).unionByName(g.withColumn("_is_gate", F.lit(1)))
    w = (
        Window.partitionBy(key, "_b")
        .orderBy(F.col(ts), F.col("_is_gate").desc())  # a gate opens before a row at the same instant
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    last_gate = F.last("_gate", ignorenulls=True).over(w)
    out = both.withColumn("_lg", last_gate).where(
        F.col(key).isNotNull() & (F.col("_is_gate") == 0) & F.col("_lg").isNotNull() & (F.col(ts) < F.col("_lg") + interval(duration))
    )
    return out.drop("_b", "_gate", "_lg", "_is_gate")


def gated_forward_until(
    rows: DataFrame,
    gates: DataFrame,
    key: str,
    ts: str,
    until: str,
    bucket: str = "1 day",
) -> DataFrame:
    """Rows whose key has an open gate, where every gate row carries its own
    end: opened at ``ts``, open while time < ``until``.

    A short gate may open and close inside a long one, so the latest gate
    alone does not decide; the latest end of all gates opened so far does.
    That is a running maximum per key, taken in (key, bucket) parts with the
    maximum of earlier buckets carried in, so neither a hot key nor a gate
    open over many buckets is copied or collected.  A gate opens before a row
    of the same instant; rows and gates without key or time pass and open
    nothing; a gate that ends before it opens is never open."""
    own = rows.columns
    named = rows.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(own)], F.col(key).alias("_k"), F.col(ts).alias("_t"))
    opened = gates.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.col(until).alias("_until"))
    both = named.where(F.col("_k").isNotNull() & F.col("_t").isNotNull()).withColumn("_o", F.lit(1))
    both = both.unionByName(opened.withColumn("_o", F.lit(0)), allowMissingColumns=True)
    scanned = keyed_prefix(both, "_k", ["_t", "_o"], F.col("_until"), "_open", agg="max", bucket=bucket)
    passed = scanned.where((F.col("_o") == 1) & (F.col("_t") < F.col("_open")))
    return passed.select(*[F.col(f"_r{i}").alias(c) for i, c in enumerate(own)])


def timed_out(
    starts: DataFrame, follow: DataFrame, key: str, start_ts: str, follow_ts: str, limit: str
) -> DataFrame:
    """Start rows whose key has no follow-up row at or before start + limit.
    A follow-up that is earlier than the start counts as well: the start then
    finds its key settled and arms no timer.  Only a key's first follow-up
    matters, so the follow-ups of a hot key are combined before the shuffle."""
    first = follow.groupBy(F.col(key).alias("_fk")).agg(F.min(follow_ts).alias("_ft"))
    cond = (F.col(key) == F.col("_fk")) & (F.col("_ft") <= F.col(start_ts) + interval(limit))
    return starts.join(first, cond, "left_anti")


def left_join_salted(
    left: DataFrame, right: DataFrame, keys: list[str], hot_share: float = 1 / 256, salts: int = 16
) -> DataFrame:
    """Left outer equi-join on any number of keys that a hot key does not slow
    down.

    The keys of ``left`` that may hold more than ``hot_share`` of its rows are
    found by a frequent-items sketch (one pass, about ``1 / hot_share`` hashes
    whatever the input; it may name too many, never too few).  Rows of those
    keys are dealt over ``salts`` parts on the left and copied to each of them
    on the right; all others have one part.  A null key joins nothing and keeps
    its left row.  Columns of both sides but for the keys must differ."""
    h = F.xxhash64(*keys)
    found = left.select(h.alias("h")).freqItems(["h"], hot_share).first()[0] or []
    hot = h.isin([int(x) for x in found]) if found else F.lit(False)
    part = F.when(hot, F.pmod(F.xxhash64(*left.columns, F.monotonically_increasing_id()), F.lit(salts))).otherwise(F.lit(0)).cast("int")
    copies = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    a, b = left.withColumn("_part", part), right.withColumn("_part", copies)
    return a.join(b, [*keys, "_part"], "left").drop("_part")


def self_left_join_count(df: DataFrame, a: str, b: str, ways: int = 3, name: str = "cnt") -> DataFrame:
    """``SELECT t1.a, t2.b, count(t1.a) FROM t t1 LEFT JOIN t t2 ON (a, b)
    [LEFT JOIN t t3 ON (a, b) ...] GROUP BY t1.a, t2.b`` without materialising
    the m**ways joined rows: a group of m rows with both keys set yields m**ways
    rows, a row with a null key joins nothing and keeps one row with t2.b null.
    The count is ``decimal(38, 0)``: m**3 leaves the range of a bigint at about
    two million rows a group."""
    per = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("_m"), F.count(a).alias("_ma"))
    matched = F.col(a).isNotNull() & F.col(b).isNotNull()
    wide = "decimal(38,0)"
    m = F.col("_m").cast(wide)
    power = m
    for _ in range(ways - 1):
        power = (power * m).cast(wide)
    return per.select(
        a,
        F.when(matched, F.col(b)).alias(b),
        F.when(matched, power).otherwise(F.col("_ma").cast(wide)).alias("_c"),
    ).groupBy(a, b).agg(F.sum("_c").cast(wide).alias(name))
