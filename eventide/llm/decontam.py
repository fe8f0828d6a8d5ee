"""Benchmark decontamination with one Aho-Corasick automaton.

Questions and answers are normalised to lower-case words and cut into windows
of ten words (a shorter item is one window).  All windows go into one
automaton, which reads each normalised text once; a match is turned into word
numbers, and those into code-point offsets of the original text.

The automaton is built from a benchmark whose size is checked: beyond
``SHARD_BYTES`` of windows it is built in shards, which the documents pass one
after the other, so memory stays bounded and no match is lost.

Defined results: null texts have no words; an item without words has no
window; items with a null id mark words but have no id to report; repeated
rows give repeated results; very long texts are read whole, in proportion to
their length; an empty benchmark contaminates nothing, an empty table gives no
rows; a table may have a column of any name, the result's own column then gets
another (``hits_column``)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import staged

WINDOW = 10
SHARD_BYTES = 8 << 20
HITS = "__decontam_hits"

#: Everything of ASCII but letters and digits separates words.
FOLD = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(pattern, n_words, ids): distinct windows and the items that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, patterns, sizes = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = fold(t)
                for i in range(max(1, len(w) - window + 1) if w else 0):
                    part = w[i : i + window]
                    ids.append(k)
                    patterns.append(f" {b' '.join(part).decode()} ")
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(patterns, pa.string()), pa.array(sizes, pa.int32())],
                names=["id", "pattern", "n_words"],
            )

    rows = items.select(F.col("item_id").cast("string"), "text").mapInArrow(run, "id string, pattern string, n_words int")
    return rows.groupBy("pattern", "n_words").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def _scan(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, word ranges of matches, items found."""
    w = fold(text)
    if not w or not len(automaton):
        return len(w), [], set()
    line = f" {b' '.join(w).decode()} "
    found = list(automaton.iter(line))
    if not found:
        return len(w), [], set()
    gaps = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 0x20)
    last = np.searchsorted(gaps, [end for end, _ in found])  # the gap after word k has number k + 1
    ids: set[str] = set()
    ranges = set()
    for k, (_, (n, own)) in zip(last.tolist(), found, strict=True):
        ranges.add((k - n, k))
        ids.update(own)
    return len(w), sorted(ranges), ids


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Code-point offsets, end exclusive, of the ranges of words in ``text``."""
    at = [m.span() for m in ORIGINAL_WORD.finditer(text)]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in ranges]


_HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("words", T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    ]
)
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("words", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def hits_column(columns: list[str]) -> str:
    """Name of the column that ``scan`` adds to a table with these columns."""
    name = HITS
    while name.lower() in [c.lower() for c in columns]:
        name += "_"
    return name


def _pass(docs: DataFrame, patterns: list, keep_text: bool, own: str, again: bool) -> DataFrame:
    """One automaton over all rows; hits of an earlier pass, in the column
    ``own``, are joined in."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for r in patterns:
        automaton.add_word(r["pattern"], (r["n_words"], tuple(r["ids"])))
    if patterns:
        automaton.make_automaton()
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    text_at = docs.columns.index("text")
    kept = [i for i, c in enumerate(docs.columns) if c != own and (keep_text or i != text_at)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for b in batches:
            before = b.column(b.num_columns - 1).to_pylist() if again else [None] * b.num_rows
            hits = []
            for t, old in zip(b.column(text_at), before, strict=True):
                t = t.as_py()
                n, ranges, ids = _scan(t, machine)
                if old:
                    ranges += [(x["a"], x["b"]) for x in old["words"]]
                    ids.update(old["items"])
                ranges = _merged(ranges)
                hits.append(
                    {
                        "n_words": n,
                        "words": [{"a": x, "b": y} for x, y in ranges],
                        "items": sorted(ids),
                        "spans": _spans(t, ranges) if ranges else [],
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in kept), pa.array(hits, _ARROW)], names=[*(str(i) for i in kept), "hits"]
            )

    fields = [T.StructField(str(i), docs.schema[i].dataType) for i in kept]
    out = docs.mapInArrow(run, T.StructType([*fields, T.StructField("hits", _HITS)]))
    return out.toDF(*[docs.columns[i] for i in kept], own)


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct column ``hits_column(docs.columns)``: n_words, word ranges hit, ids of
    the items found, and the spans of the hits in the original text."""
    patterns = staged(item_windows(items, window), "decontam-patterns")
    size = patterns.agg(F.sum(F.octet_length("pattern"))).first()[0] or 0
    shards = int(size // SHARD_BYTES) + 1
    name = hits_column(docs.columns)
    for k in range(shards):
        own = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(shards)) == k).collect()  # at most about SHARD_BYTES
        final = k == shards - 1
        docs = _pass(docs, own, keep_text or not final, name, k > 0)
        if not final:
            docs = staged(docs, "decontam-pass")
    return docs


def n_hit():
    return F.aggregate(F.col(f"{HITS}.words"), F.lit(0).cast("long"), lambda a, r: a + (r["b"] - r["a"]))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` in which no benchmark window occurs."""
    own = hits_column(docs.columns)
    return scan(docs, items, window).where(F.size(f"{own}.words") == 0).drop(own)
