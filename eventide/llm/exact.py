"""Exact dedup: rows are grouped by a 128-bit hash of their normalised text,
the bytes inside each group are compared, and one row of each class stays.

The comparison of bytes is an aggregate on (hash, text): each task first
reduces its own copies of a text to one row, so a group with a third of all
rows moves no more text than it has tasks, and a hash with two texts shows as
two rows.  Such a hash is a collision: its rows are then told apart by the text
itself.  Everything else works on rows without texts.

Defined results: a null text counts as empty; all empty texts are one class; of
a class the row with the most code points in its original text stays, then the
smallest id (nulls last), then one of the rows that are equal in both;
repeated rows count each; an empty table gives no rows; other columns are not
read, so their names can't clash; texts are hashed and compared whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import BLANK, join_split, staged


def without_blanks(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def md5_bytes(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _best(size: Column, doc_id: Column, row: Column) -> Column:
    """The row that stays has the smallest of these."""
    return F.struct((-size).alias("size"), doc_id.isNull().alias("no_id"), doc_id.alias("id"), row.alias("row"))


def mark_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = without_blanks,
    hasher: Callable[[Column], Column] = md5_bytes,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), normalise(F.col(text)).alias("norm"))
    hashed = plain.withColumn("h", hasher(F.col("norm")))

    # the texts of each hash: one of them, or a collision
    texts = hashed.groupBy("h", "norm").agg(F.count(F.lit(1)).alias("group_size"))
    texts = staged(texts.select("h", F.sha2("norm", 256).alias("text_sha256"), "group_size"), "exact-texts")
    collided = texts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    rows = hashed.select("doc_id", "h", F.char_length(F.coalesce("text", F.lit(""))).alias("size"), "norm")
    if collided.isEmpty():
        rows = rows.withColumn("variant", F.lit(0))
        texts = texts.withColumn("variant", F.lit(0))
    else:
        collided = staged(collided, "exact-collisions")
        own = hashed.join(collided, "h", "left_semi").groupBy("h", "norm").agg(F.count(F.lit(1)).alias("group_size"))
        nth = F.row_number().over(Window.partitionBy("h").orderBy("norm"))
        own = staged(own.withColumn("variant", nth), "exact-variants")
        rows = rows.join(own.select("h", "norm", "variant"), ["h", "norm"], "left").withColumn("variant", F.coalesce("variant", F.lit(0)))
        texts = texts.join(collided, "h", "left_anti").withColumn("variant", F.lit(0))
        texts = texts.unionByName(own.select("h", F.sha2("norm", 256).alias("text_sha256"), "group_size", "variant"))

    rows = rows.select("doc_id", "h", "variant", "size", F.monotonically_increasing_id().alias("row"))
    rows = staged(rows, "exact-rows")  # row numbers hold from here
    best = rows.groupBy("h", "variant").agg(F.min(_best(F.col("size"), F.col("doc_id"), F.col("row"))).alias("best"))
    groups = texts.join(best, ["h", "variant"]).select("h", "variant", "text_sha256", "group_size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    groups = staged(groups, "exact-groups")
    marked = join_split(rows, groups, ["h", "variant"], F.col("group_size"), rows.count())
    return marked.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, one row of each class: the one that
    ``mark_duplicates`` keeps, found by a hash of its text, its size and its id
    (``docs`` is read again, and row numbers do not hold from read to read)."""
    names = docs.columns
    own = docs.toDF(*[f"c{i}" for i in range(len(names))])
    a, t = (F.col(f"c{names.index(n)}") for n in (doc_id, text))
    norm = without_blanks(t)
    own = own.withColumn("sha", F.sha2(norm, 256)).withColumn("size", F.char_length(F.coalesce(t, F.lit("")))).withColumn("id", a)
    kept = mark_duplicates(docs, doc_id, text).where("kept").select(F.col("text_sha256").alias("sha"), F.col("keep_id").alias("id"))
    same = own["sha"].eqNullSafe(kept["sha"]) & own["id"].eqNullSafe(kept["id"])
    # a few rows at most are equal in text and id
    best = own.join(kept, same, "left_semi").groupBy("sha").agg(F.max_by(F.struct(*[f"c{i}" for i in range(len(names))]), "size").alias("best"))
    return best.select("best.*").toDF(*names)
