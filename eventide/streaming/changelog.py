"""Changelog of an updating result, kept in files.

An update-mode stream emits a group's new value whenever it changes.  A sink
that only adds or overwrites single rows keeps rows that have left a result
(rank rows of a top-N).  ``VersionedTable`` replaces whole groups: every
micro-batch writes the new rows of the groups it touched into a folder of its
own, and a commit folder, written last, makes the version visible.  A reader
takes each group from the last committed micro-batch that touched it, so rows
that left are gone; a replayed micro-batch overwrites its own folders and sees
the state before it; a failed one leaves nothing visible.

The rows removed and added by a micro-batch, the changelog itself, are written
beside it: summed with their signs they give the table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.ranking import top_n_per_group
from eventide.streaming.sinks import _read_or_none

BATCH = "batch_id"


class VersionedTable:
    """Rows of groups (columns ``group``), replaced group by group.

    ``rows``, ``touched`` and ``changes`` hold one folder a micro-batch,
    ``snapshots`` the whole table as of some; ``commits`` says what counts."""

    def __init__(self, spark: SparkSession, path: str, group: Sequence[str]):
        self.spark, self.path, self.group = spark, path, list(group)

    def _folder(self, part: str, batch_id: int) -> str:
        return f"{self.path}/{part}/{BATCH}={batch_id}"

    def _part(self, part: str) -> DataFrame | None:
        return _read_or_none(self.spark, f"{self.path}/{part}")

    def version(self, part: str = "commits", before: int | None = None) -> int | None:
        """The last micro-batch in ``part``, or the last below ``before``."""
        df = self._part(part)
        if df is None:
            return None
        return (df if before is None else df.where(F.col(BATCH) < before)).agg(F.max(BATCH)).first()[0]

    def read(self, before: int | None = None) -> DataFrame | None:
        """The table after the last commit (below ``before``); None if there
        is none."""
        last = self.version(before=before)
        if last is None:
            return None
        base = self.version("snapshots", before=last + 1)
        new = F.col(BATCH) <= last
        if base is not None:
            new = new & (F.col(BATCH) > base)
        rows, touched = self._part("rows").where(new), self._part("touched").where(new)
        latest = touched.groupBy(*self.group).agg(F.max(BATCH).alias("_last"))
        same = [rows[g].eqNullSafe(latest[g]) for g in self.group]
        now = rows.join(latest, [*same, rows[BATCH] == latest["_last"]], "left_semi").drop(BATCH)
        if base is not None:
            old = self.spark.read.parquet(self._folder("snapshots", base))
            now = now.unionByName(old.join(latest, [old[g].eqNullSafe(latest[g]) for g in self.group], "left_anti"))
        return now

    def changes(self) -> DataFrame | None:
        """(rows, sign, batch_id): what each committed micro-batch removed (-1)
        and added (+1)."""
        last = self.version()
        return None if last is None else self._part("changes").where(F.col(BATCH) <= last)

    def replace(self, rows: DataFrame, touched: DataFrame, batch_id: int) -> None:
        """Version ``batch_id``: the groups in ``touched`` hold ``rows`` now,
        the others what they held."""
        rows.write.mode("overwrite").parquet(self._folder("rows", batch_id))
        touched.select(*self.group).distinct().write.mode("overwrite").parquet(self._folder("touched", batch_id))
        new, keys = (self.spark.read.parquet(self._folder(p, batch_id)) for p in ("rows", "touched"))
        signed = new.withColumn("sign", F.lit(1))
        old = self.read(before=batch_id)
        if old is not None:
            gone = old.join(keys, [old[g].eqNullSafe(keys[g]) for g in self.group], "left_semi").select(*new.columns)
            signed = signed.unionByName(gone.withColumn("sign", F.lit(-1)))
        signed = signed.groupBy(*new.columns).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0")
        signed.write.mode("overwrite").parquet(self._folder("changes", batch_id))
        self.spark.range(1).select(F.lit(True).alias("committed")).write.mode("overwrite").parquet(self._folder("commits", batch_id))

    def snapshot(self) -> None:
        """Write the table as of the last commit, so that later reads need no
        older micro-batch."""
        now = self.read()
        if now is not None:
            now.write.mode("overwrite").parquet(self._folder("snapshots", self.version()))


def top_n_writer(path: str, group: Sequence[str], key: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for an update-mode aggregation: keeps the
    latest row of every (group, key) and the top ``n`` of each group as a
    ``VersionedTable`` at ``path/top``.  Only groups that a micro-batch touches
    are ranked again."""

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/values/{BATCH}={batch_id}")
        values = spark.read.parquet(f"{path}/values").where(F.col(BATCH) <= batch_id)
        touched = spark.read.parquet(f"{path}/values/{BATCH}={batch_id}").select(*group).distinct()
        mine = values.join(touched, [values[g].eqNullSafe(touched[g]) for g in group], "left_semi")
        rest = [c for c in batch.columns if c not in (*group, *key)]
        now = mine.groupBy(*group, *key).agg(F.max_by(F.struct(*rest), BATCH).alias("v")).select(*group, *key, "v.*")
        VersionedTable(spark, f"{path}/top", group).replace(top_n_per_group(now, list(group), list(order), n, rank), touched, batch_id)

    return fn
