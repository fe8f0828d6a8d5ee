"""Keyed state on streams without a key's rows in one task.

``foreachBatch`` runs the bucketed scans of ``eventide.operators`` over a
micro-batch together with a small table of what each key carries over from the
earlier ones (its last rows, its running values).  A key with a third of all
rows is split by time bucket like in a batch; columns keep their types, so any
value, empty or null, is state like any other, and a null key is a key.

Each micro-batch writes its results and the table for the next one under its
batch id, so a replayed micro-batch starts from the same table and overwrites
its own results.  The carried table has a fixed number of rows a key and is
written whole.  Micro-batches are taken in event-time order, the order a
bounded source drained by time slices has; inside one, rows are ordered by
(time, event)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.keyed import DEFAULT_BUCKET, keyed_prefix
from eventide.operators.ranking import top_n_per_group
from eventide.operators.sequences import BITS, ORDER, step_bits, strict_sequence
from eventide.streaming.sinks import _read_or_none

Writer = Callable[[DataFrame, int], None]


def _write(df: DataFrame, path: str, part: str, batch_id: int) -> DataFrame:
    folder = f"{path}/{part}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _before(spark: SparkSession, path: str, part: str, batch_id: int) -> DataFrame | None:
    return _read_or_none(spark, f"{path}/{part}/batch_id={batch_id - 1}")


def last_state(spark: SparkSession, path: str, part: str) -> DataFrame:
    """``part`` as the last micro-batch left it."""
    last = spark.read.parquet(f"{path}/{part}").agg(F.max("batch_id")).first()[0]
    return spark.read.parquet(f"{path}/{part}/batch_id={last}")


def sequence_writer(
    path: str,
    key: str,
    steps: Sequence[Column],
    within: str,
    carry: Sequence[str] = ("event_id",),
    order: Sequence[str] = ORDER,
    bucket: str = DEFAULT_BUCKET,
) -> Writer:
    """``strict_sequence`` on a stream: matches go to ``path/matches`` with the
    micro-batch of their last row; a key carries its last n - 1 rows."""
    n = len(steps)
    names = list(dict.fromkeys([*order, *carry]))
    held = [F.col(BITS).bitwiseAND(F.lit(1 << j).cast("long")) != 0 for j in range(n)]

    def fn(batch: DataFrame, batch_id: int) -> None:
        new = _write(batch.select(key, *names, step_bits(steps).alias(BITS)), path, "rows", batch_id).withColumn("_new", F.lit(True))
        old = _before(batch.sparkSession, path, "tail", batch_id)
        both = new if old is None else new.unionByName(old.withColumn("_new", F.lit(False)))
        found = strict_sequence(both, key, None, held, within, [*carry, "_new"], order, bucket)
        _write(found.where(F.col(f"_new_{n}")).drop(*[f"_new_{j + 1}" for j in range(n)]), path, "matches", batch_id)
        if n > 1:
            latest = [F.col(c).desc_nulls_last() for c in order]
            _write(top_n_per_group(both.drop("_new"), [key], latest, n - 1, "_rank").drop("_rank"), path, "tail", batch_id)

    return fn


def state_kinds_writer(
    path: str,
    key: str,
    clear: Column,
    item: Column,
    value: Column,
    order: Sequence[str] = ORDER,
    bucket: str = DEFAULT_BUCKET,
) -> Writer:
    """Value, list, map and reducing state of a key.  A row for which ``clear``
    holds clears all of them first and is applied then: it begins a new epoch.

    * ``path/values``: (key, epoch, n, max_ts, min_value), counter and
      reducing state, one row a key;
    * ``path/counts``: (key, epoch, item, c), map state;
    * ``path/list``: (key, epoch, pos, item, order columns), list state in row
      form, appended by each micro-batch and never rewritten or cut: the list
      of a key is its rows of its present epoch."""
    ts = order[0]

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(
            key, *order, F.coalesce(clear, F.lit(False)).cast("long").alias("_add"), F.lit(1).cast("long").alias("_n"),
            item.alias("item"), F.col(ts).alias("max_ts"), value.alias("min_value"), F.lit(True).alias("_new"),
        )
        old = _before(spark, path, "values", batch_id)
        if old is not None:  # what a key carries comes before its rows: it has no time
            carried = old.select(key, F.col("epoch").alias("_add"), F.col("n").alias("_n"), "max_ts", "min_value", F.lit(False).alias("_new"))
            rows = rows.unionByName(carried, allowMissingColumns=True)
        rows = _write(rows, path, "rows", batch_id)
        first = ["_new", *order[1:]]
        epochs = _write(keyed_prefix(rows, key, [ts, *first], F.col("_add"), "epoch", bucket=bucket), path, "epochs", batch_id)
        placed = keyed_prefix(epochs, [key, "epoch"], [ts, *first], F.col("_n"), "pos", bucket=bucket)
        _write(placed.where("_new").select(key, "epoch", "pos", "item", *order), path, "list", batch_id)

        state = epochs.groupBy(key, "epoch").agg(F.sum("_n").alias("n"), F.max("max_ts").alias("max_ts"), F.min("min_value").alias("min_value"))
        fields = ["n", "max_ts", "min_value"]
        now = state.groupBy(key).agg(F.max(F.struct("epoch", *fields)).alias("s")).select(key, "s.*")
        now = _write(now, path, "values", batch_id)
        counts = epochs.where("_new").groupBy(key, "epoch", "item").agg(F.count(F.lit(1)).alias("c"))
        before = _before(spark, path, "counts", batch_id)
        if before is not None:
            counts = counts.unionByName(before).groupBy(key, "epoch", "item").agg(F.sum("c").alias("c"))
        present = (counts[key].eqNullSafe(now[key])) & (counts["epoch"] == now["epoch"])
        _write(counts.join(now, present, "left_semi"), path, "counts", batch_id)

    return fn


def state_list(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(key, epoch, pos, item, order columns): the present list of each key."""
    rows, now = spark.read.parquet(f"{path}/list").drop("batch_id"), last_state(spark, path, "values")
    return rows.join(now, rows[key].eqNullSafe(now[key]) & (rows["epoch"] == now["epoch"]), "left_semi")


def list_texts(held: DataFrame, key: str, last: int) -> DataFrame:
    """(key, whole, last) of ``state_list``: each key's list as text, whole and
    its ``last`` latest entries; null entries have no text."""
    entries = held.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("e")).select(key, F.col("e.item").alias("e"))

    def text(e: Column) -> Column:
        return F.when(F.exists(e, lambda x: x.isNotNull()), F.array_join(e, ","))

    return entries.select(key, text(F.col("e")).alias("whole"), text(F.slice("e", F.greatest(F.size("e") - (last - 1), F.lit(1)), F.lit(last))).alias("last"))


def counter_writer(path: str) -> Writer:
    """Running counter as list state: each task adds its number of rows to the
    list, under the batch id.  What is restored after a restart is the list;
    ``restored_count`` sums it, whatever the number of tasks before and now."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        own = batch.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
        _write(own, path, "counter", batch_id)

    return fn


def restored_count(spark: SparkSession, path: str) -> int:
    held = _read_or_none(spark, f"{path}/counter")
    return 0 if held is None else held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
