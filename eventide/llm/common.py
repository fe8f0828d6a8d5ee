"""Helpers shared by the training-data operators: table access, scratch tables
in the shared checkpoint folder, and the word classes of the contracts."""

from __future__ import annotations

import gc
import sys
import time
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import scratch_path

#: Separators of "words" (ASCII white space) as a Java pattern.
BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: the
    lineage ends there, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the driver forget finished plans, so that Spark's cleaner deletes
    the shuffle files of steps whose results are already staged."""
    for _ in range(2):  # the cleaner works behind the collector
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def words(text: Column) -> Column:
    """Array of words; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def row_key(*cols: Column) -> Column:
    """64-bit key of a row by its content; equal rows share it."""
    return F.xxhash64(*cols)


def kept_by_process(key: tuple, make: Callable):
    """``make()``, once in each Python worker process: Spark reuses workers
    for many tasks, so models and compiled tables need not be loaded by each.
    A few keys are kept at most."""
    kept = sys.modules.setdefault("eventide_llm_kept", ModuleType("eventide_llm_kept")).__dict__
    mine = kept.setdefault("objects", {})
    if key not in mine:
        if len(mine) >= 4:
            mine.clear()
        mine[key] = make()
    return mine[key]


#: A key is hot if more than one row in this many has it; so there are at most this many hot keys.
HOT_SHARE = 4096


def join_split(rows: DataFrame, found: DataFrame, on: list[str], weight: Column | None = None, total: int | None = None, share: int = HOT_SHARE) -> DataFrame:
    """Inner join of ``rows`` with ``found`` (unique in ``on``, no null keys)
    that no hot key slows down: the entries of hot keys, ``share`` at most
    whatever the size of the input, are broadcast, so their rows stay where
    they are; the other rows are shuffled, and no key has many of them.

    ``weight`` is a column of ``found`` with the rows of a key in ``rows`` and
    ``total`` the number of rows, where known; else both are counted.  Both
    inputs are read more than once and should be staged."""
    if weight is None:
        sizes = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
        total = rows.count()
        hot = sizes.where(F.col("__rows") * share > total).select(*on)
        hot = found.join(F.broadcast(hot), on)
    else:
        hot = found.where(weight * share > total)
    keys = hot.select(*on)
    cold = found.join(F.broadcast(keys), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(F.broadcast(keys), on, "left_anti").join(cold, on))
