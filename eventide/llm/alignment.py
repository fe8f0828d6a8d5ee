"""Alignment of two tokenizers over the same bytes.

Tokenizer A is byte-level and reads a space and the text; tokenizer B is a
piece model that puts that space itself.  Every token covers bytes, so both
token lists have cumulative ends.  A dictionary takes the ends of each to token
numbers; the intersection of their key sets, sorted, are the places where both
have a token end, and cuts both id lists into groups.  The tokens that end
there together, the last of each slice, are linked.

Counts of linked id pairs are summed by Spark over the corpus.  Documents get
them back by a join; the commonest pairs, at most ``HOT_PAIRS``, are broadcast
and the rest is shuffled.

Defined results: texts that are null or empty, or whose token bytes are not the
space and the text in either tokenizer, have no tokens, groups or links;
repeated rows are aligned and counted each; ties for the best partner of a B id
all count; texts are read whole; an empty table gives no rows; other columns
are not read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import join_split, kept_by_process, staged

MARK = "▁"  # the piece model's space
GROUP_CHARS = 1 << 20  # text aligned at a time
HOT_PAIRS = 1 << 18

#: Fixed value: how a byte-level tokenizer cuts a text before it merges bytes.
BYTE_LEVEL_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary: printable Latin-1 stands for
    itself, the other bytes in turn for the code points from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}


def byte_level_encoder(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """(ids of a text, bytes of an id).  Where the vocabulary is numbered in
    the order of its merges, as usual, the ids are merge ranks and the faster
    library for such tables is used; special tokens in a text are plain text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
    import json

    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    alphabet = byte_alphabet()
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        spelled[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    cut, merges = whole["pre_tokenizer"], whole["model"]["merges"]
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    by_rank = all(vocabulary.get(m) == 256 + k for k, m in enumerate(made)) and not whole["normalizer"] and not whole["model"].get("ignore_merges")
    if by_rank and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
        ranks = {spelled[i]: i for i in range(256 + len(made))}
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, spelled
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, spelled


class Aligned(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    groups: str  # a1,a2|b1;a3|b2,b3
    links: np.ndarray  # distinct links, id of A << 32 | id of B
    n: np.ndarray  # how many of each


NOTHING = Aligned(0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, byte_level: str, piece_model: str):
        import sentencepiece

        self.a, a_bytes = byte_level_encoder(byte_level)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_bytes, self.b_bytes = _objects(a_bytes), _objects(b_bytes)
        self.a_size, self.b_size = np.array(list(map(len, a_bytes))), np.array(list(map(len, b_bytes)))
        # an id of A inside and at the end of its slice, an id of B inside and at the end
        ids = [range(len(a_bytes)), range(len(a_bytes)), range(len(b_bytes)), range(len(b_bytes))]
        self.spelled = _objects([f"{i}{mark}" for mark, own in zip(",|,;", ids, strict=True) for i in own])

    def slices(self, text: str, a: np.ndarray, b: np.ndarray) -> Aligned:
        data = b" " + text.encode()
        if b"".join(self.a_bytes[a].tolist()) != data or b"".join(self.b_bytes[b].tolist()) != data:
            return NOTHING
        at_a = dict(zip(np.cumsum(self.a_size[a]).tolist(), range(1, len(a) + 1), strict=True))
        at_b = dict(zip(np.cumsum(self.b_size[b]).tolist(), range(1, len(b) + 1), strict=True))
        common = sorted(at_a.keys() & at_b.keys())
        to_a, to_b = (np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (at_a, at_b))
        # a slice of A is followed by the slice of B of the same group
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[to_a - 1] = last_b[to_b - 1] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, to_b)[group_a]] = a + last_a * len(self.a_bytes)
        order[np.arange(len(b)) + to_a[group_b]] = b + last_b * len(self.b_bytes) + 2 * len(self.a_bytes)
        groups = "".join(self.spelled[order].tolist())[:-1]
        links, n = np.unique(a[to_a - 1].astype(np.int64) << 32 | b[to_b - 1], return_counts=True)
        return Aligned(len(a), len(b), len(common), groups, links, n)

    def align(self, texts: list[str | None]) -> list[Aligned]:
        ids_b = self.b.encode([t or "" for t in texts], num_threads=1)
        return [self.slices(t, np.array(self.a(" " + t), np.int32), np.array(b, np.int32)) if t else NOTHING for t, b in zip(texts, ids_b, strict=True)]


def _rows(ids: pa.Array, found: list[Aligned], names: list[str]) -> pa.RecordBatch:
    at = np.append(0, np.cumsum([len(f.links) for f in found])).astype(np.int32)
    links, n = np.concatenate([f.links for f in found]), np.concatenate([f.n for f in found])
    pairs = pa.StructArray.from_arrays([pa.array((links >> 32).astype(np.int32)), pa.array(links.astype(np.int32)), pa.array(n.astype(np.int32))], ["a", "b", "n"])
    sizes = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
    columns = [ids, *sizes, pa.array([f.groups for f in found], pa.string()), pa.ListArray.from_arrays(pa.array(at), pairs)]
    return pa.RecordBatch.from_arrays(columns, names=names)


COLUMNS = "n_a long, n_b long, n_groups long, groups string, links array<struct<a: int, b: int, n: int>>"


def align(docs: DataFrame, byte_level: str, piece_model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, links): numbers of tokens and
    groups, the ids by group as ``a1,a2|b1;a3|b2,b3``, and the linked id pairs
    of a document with their number."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *T._parse_datatype_string(COLUMNS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = kept_by_process(("alignment", byte_level, piece_model), lambda: Pair(byte_level, piece_model))
        for batch in batches:
            first, chars, texts = 0, 0, []
            for k, t in enumerate(batch.column(1)):
                texts.append(t.as_py())
                chars += len(texts[-1] or "")
                if chars >= GROUP_CHARS or k + 1 == batch.num_rows:
                    yield _rows(batch.column(0).slice(first, len(texts)), pair.align(texts), schema.fieldNames())
                    first, chars, texts = k + 1, 0, []

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def group_ids(groups: Column) -> Column:
    """The ids in ``groups`` as array<struct<a: array<int>, b: array<int>>>."""

    def listed(side: Column) -> Column:
        return F.split(side, ",").cast("array<int>")

    halves = F.transform(F.split(groups, ";"), lambda g: F.split(g, r"\|"))
    return F.when(groups == "", F.array()).otherwise(F.transform(halves, lambda h: F.struct(listed(h[0]).alias("a"), listed(h[1]).alias("b"))))


def link_counts(links: DataFrame) -> DataFrame:
    """(a, b, count, best) of the linked id pairs of ``links`` (a, b, n):
    the links of the whole corpus, and whether no other A id has more with
    the B id.  A B id has at most as many pairs as A has ids."""
    counts = links.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def link_strength(rows: DataFrame) -> DataFrame:
    """(row, n_links, n_best, count_sum) of the rows with links; ``rows``
    (row, links) staged."""
    links = rows.select("row", F.explode("links").alias("l")).select("row", "l.*")
    counts = staged(link_counts(links), "alignment-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    found = join_split(links, counts, ["a", "b"], F.col("count"), total, HOT_PAIRS)
    n = F.col("n").cast("long")
    return found.groupBy("row").agg(
        F.sum(n).alias("n_links"), F.sum(F.when(F.col("best"), n).otherwise(0)).alias("n_best"), F.sum(n * F.col("count")).alias("count_sum")
    )
