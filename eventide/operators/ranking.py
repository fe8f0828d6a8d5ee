"""Top-N per group and global top-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """``row_number() <= n`` per group.  Catalyst turns the filter into a
    partial group limit below the shuffle, so at most n rows per group and
    input partition are exchanged - a hot group never travels whole."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= n)
        .withColumn(rank, F.col("_rn").cast("bigint"))
        .drop("_rn")
    )


def top_n_global(df: DataFrame, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Global ``ORDER BY ... LIMIT n`` (per-partition top-n, then one merge of
    n rows per partition), ranked 1..n."""
    head = df.orderBy(*order).limit(n)
    w = Window.orderBy(*order)  # n rows only
    return head.withColumn(rank, F.row_number().over(w).cast("bigint"))
