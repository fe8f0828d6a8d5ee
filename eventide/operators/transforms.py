"""Row-wise maps and filters, unions, connect/co-map, side outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_union(parts: Sequence[tuple[str, DataFrame]], tag: str = "tag") -> DataFrame:
    """Bag union (UNION ALL) of same-shaped frames, each tagged."""
    out = None
    for name, df in parts:
        t = df.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out


def connect_comap(left: DataFrame, right: DataFrame, f1: Column, f2: Column, name: str = "msg") -> DataFrame:
    """Connected streams with one map per side and one output type: each side
    is projected on its own, then unioned (the two maps never meet)."""
    return left.select(f1.alias(name)).unionByName(right.select(f2.alias(name)))


def side_outputs(df: DataFrame, outputs: dict[str, Column | None], tag: str = "tag") -> DataFrame:
    """Main output plus side outputs from one parent, as one frame with a tag
    column; ``None`` predicate = every row (the main output).  The parent is
    read once: a row gets the array of the outputs it belongs to, and the array
    is exploded.  Read a side output back with ``where(tag = name)``, or write
    all of them at once with ``write_outputs``."""
    tags = [F.lit(name) if pred is None else F.when(pred, name) for name, pred in outputs.items()]
    return df.withColumn(tag, F.explode(F.array_compact(F.array(*tags))))


def write_outputs(tagged: DataFrame, path: str, tag: str = "tag") -> dict[str, DataFrame]:
    """Write all outputs in one pass, a folder each, and read each back."""
    tagged.write.mode("overwrite").partitionBy(tag).parquet(path)
    spark = tagged.sparkSession
    whole = spark.read.parquet(path)
    return {r[0]: whole.where(F.col(tag) == r[0]).drop(tag) for r in whole.select(tag).distinct().toLocalIterator()}


def rich_map(
    df: DataFrame,
    fn: Callable[[pd.DataFrame, object], pd.DataFrame],
    schema: str,
    open_fn: Callable[[], object] = lambda: None,
    close_fn: Callable[[object], None] = lambda ctx: None,
) -> DataFrame:
    """Rich map: per-task set-up (``open``), a vectorised map over Arrow
    batches, and tear-down (``close``) in ``finally``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = open_fn()
        try:
            for b in batches:
                yield fn(b, ctx)
        finally:
            close_fn(ctx)

    return df.mapInPandas(run, schema)


# fixed values: the whitespace class of Java's "\\s" (space, tab, newline,
# vertical tab, form feed, carriage return)
JAVA_WS = " \t\n\x0b\f\r"


def split_words(text: Column) -> Column:
    """Java ``String.split("\\s")`` on a line: pieces between single
    whitespace characters; trailing empty pieces are dropped, inner and
    leading ones kept; a line of only whitespace gives no piece.

    Whitespace is first mapped to a space (``translate``, a per-character
    table), so the split is a single-character split and the trailing trim
    a plain ``rtrim`` - no regular expression runs over the text."""
    spaced = F.translate(text, JAVA_WS[1:], " " * (len(JAVA_WS) - 1))
    trimmed = F.rtrim(spaced)
    return F.when((trimmed == "") & (text != ""), F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))
