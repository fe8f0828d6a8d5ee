"""Connected components of an edge table, by alternating large-star and
small-star steps.  Each step is two aggregations and joins over edges; the
edges of every round are staged in the shared folder, so neither the lineage
nor the driver grows with the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import release, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # large-star edges run from the greater to the smaller node
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    down = moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return down.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame):
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)`` (bigint pairs, any
    order, repeats and loops allowed); root is the smallest node reachable."""
    spark = edges.sparkSession
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        after = staged(_small_star(_large_star(now)), name)
        new = _mark(after)
        now, same, mark = after, new == mark, new
        release(spark)
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
