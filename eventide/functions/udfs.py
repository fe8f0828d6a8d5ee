"""User-function surface: SQL scalar functions, vectorised pandas UDFs, an
incremental aggregate function (create / add / merge / result) and a
full-window function, all run as distributed Spark stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def register_sql_functions(spark: SparkSession) -> None:
    """SQL functions are inlined into the plan (foldable, codegen'd)."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION a(s STRING) RETURNS STRING RETURN concat(s, '1')")


@F.pandas_udf(T.DoubleType())
def plus_one(v: pd.Series) -> pd.Series:
    return v + 1.0


@dataclass
class AggregateFunction:
    """An incremental aggregate: ``add`` folds a pandas batch of one group into
    accumulator columns, accumulators ``merge`` by column-wise Spark
    aggregates, ``result`` maps merged accumulators to the output column.

    Execution: ``mapInPandas`` builds one accumulator row per group and
    input batch (the add step, no shuffle); a ``groupBy`` merges them
    (partial + final aggregation, so a hot group is merged map-side)."""

    acc_schema: str
    add: Callable[[pd.DataFrame], pd.DataFrame]
    merge: dict[str, Callable[[str], Column]]
    result: Callable[[], Column]

    def apply(self, df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        keys = list(keys)
        add = self.add

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield add(b)

        key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
        partial = df.mapInPandas(run, f"{key_schema}, {self.acc_schema}")
        merged = partial.groupBy(*keys).agg(*[fn(c).alias(c) for c, fn in self.merge.items()])
        return merged.select(*keys, self.result().alias(name))


def average_aggregate(keys: Sequence[str], value: str) -> AggregateFunction:
    """(sum, count) accumulator over the values that are not null; result =
    sum / count, null where a group has none."""
    keys = list(keys)

    def add(b: pd.DataFrame) -> pd.DataFrame:
        out = b.groupby(keys, sort=False, dropna=False)[value].agg(["sum", "count"]).reset_index()
        return out.rename(columns={"sum": "acc_sum", "count": "acc_n"})

    return AggregateFunction(
        acc_schema="acc_sum double, acc_n long",
        add=add,
        merge={"acc_sum": F.sum, "acc_n": F.sum},
        result=lambda: F.when(F.col("acc_n") > 0, F.col("acc_sum") / F.col("acc_n")),
    )


def bucket_count(df: DataFrame, per_partition: int = 4) -> int:
    """Hash buckets for grouped Python stages: a few per input partition
    (input partitions are ~128 MB on a cluster, so a bucket stays a few tens
    of MB) and at least a few per core."""
    return max(df.rdd.getNumPartitions() * per_partition, parallelism(df) * per_partition)


def key_bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n))


def each_group(f: Callable[[pd.DataFrame], pd.DataFrame], keys: Sequence[str]):
    """Adapt a per-group function to the frame-of-groups contract of
    ``window_process`` (one Python call per group: the slow path)."""
    keys = list(keys)

    def run(p: pd.DataFrame) -> pd.DataFrame:
        parts = [f(g) for _, g in p.groupby(keys, sort=False, dropna=False)]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()

    return run


def window_process(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    salt_buckets: int = 0,
) -> DataFrame:
    """Full-window function: ``fn`` gets a pandas frame holding *complete*
    (window, key) groups - every row of each group it sees - and returns the
    groups' results (vectorise it with ``groupby``, or wrap per-group code
    with ``each_group``).  This is the buffered path; prefer built-in
    aggregates.

    Groups are hashed into buckets (a few per input partition) and one
    Python call handles a bucket.  With ``combine`` and ``salt_buckets`` > 0
    a group is also cut into hash slices: ``fn`` runs on the slices (the
    slice id is a key column ``_salt``) and ``combine`` merges the slice
    results per group, so a hot group never sits whole in one worker."""
    keys = list(keys)
    n = bucket_count(df)

    def strip(f):
        return lambda p: f(p.drop(columns=["_bucket"]))

    if combine is None or salt_buckets <= 0:
        b = df.withColumn("_bucket", key_bucket(keys, n))
        return b.groupBy("_bucket").applyInPandas(strip(fn), schema)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salt_buckets)))
    salted = salted.withColumn("_bucket", key_bucket(keys + ["_salt"], n))
    partial_schema = f"{schema}, _salt long"
    first = salted.groupBy("_bucket").applyInPandas(strip(fn), partial_schema)
    second = first.drop("_salt").withColumn("_bucket", key_bucket(keys, n))
    return second.groupBy("_bucket").applyInPandas(strip(combine), schema)


def cogroup_process(
    left: DataFrame,
    right: DataFrame,
    key: str,
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Co-process function over two inputs keyed alike: ``fn`` gets the left
    and right rows of a hash bucket of keys (every key's rows of both sides
    are in the same bucket) and handles the keys in it, vectorised."""
    n = max(bucket_count(left), bucket_count(right))
    lb = left.withColumn("_bucket", key_bucket([key], n))
    rb = right.withColumn("_bucket", key_bucket([key], n))

    def run(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        return fn(lp.drop(columns=["_bucket"]), rp.drop(columns=["_bucket"]))

    return lb.groupBy("_bucket").cogroup(rb.groupBy("_bucket")).applyInPandas(run, schema)


def parallelism(df: DataFrame) -> int:
    """Task count for grouped Python stages: the cluster's cores, so many small
    groups are spread over every Python worker instead of being coalesced
    into a few partitions."""
    return max(df.sparkSession.sparkContext.defaultParallelism, 1)
