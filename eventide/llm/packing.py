"""Best-fit-decreasing packing of token pieces into fixed-length sequences.

Documents are tokenised, closed with the end id and cut into pieces of at most
one sequence.  Pieces are dealt evenly into shards of about ``SHARD_PIECES``
(by row number, so no key can make one shard large), and each shard is packed
on its own: longest piece first, into the open sequence with the least room
that still fits.  A segment tree over remaining room counts the open
sequences; the tightest is found in log2(capacity) steps.  Splitting costs at
most one part-filled sequence a shard, about 0.01 % of them.

Defined results: null texts count as empty and have the end id alone; repeated
rows are packed each; ties are broken by row order; an empty table gives no
rows; only doc_id and text are read."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import kept_by_process, staged

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 1 << 15
MEMO_WORDS = 600_000  # words whose ids a worker remembers
MEMO_PARTS = 150_000  # parts of words, likewise
LONG_WORD = 64  # characters; longer words are encoded each time
BATCH_BYTES = 1 << 21  # of text whose distinct words are looked up together
ENCODE_WORDS = 1 << 12  # that the library encodes together
BLOCK_WORDS = 1 << 14  # whose ids are gathered together, within the processor's cache
PLAIN = "\u0250"  # characters below are composed and have simple small letters


def _split_pattern(conf: dict) -> str | None:
    """The pattern by which a tokenizer cuts a printable word of characters
    below PLAIN, if it only lower-cases and cuts it and takes the parts' bytes
    before its model runs; else None."""
    normal, cut = conf["normalizer"] or {}, conf["pre_tokenizer"] or {}
    steps = {n["type"] for n in normal.get("normalizers", []) if n["type"] != "Replace" or n["pattern"] == {"Regex": "\\s+"}}
    parts = cut.get("pretokenizers", [])
    # composition and white space do not concern such words
    if len(steps) != len(normal.get("normalizers", [])) or "Lowercase" not in steps or steps - {"NFC", "Replace", "Lowercase"}:
        return None
    if [p["type"] for p in parts] != ["Split", "ByteLevel"] or conf["post_processor"] or conf["truncation"]:
        return None
    split, byte_level = parts
    if (split["behavior"], split["invert"]) != ("Removed", True) or byte_level["add_prefix_space"] or byte_level["use_regex"]:
        return None
    return split["pattern"].get("Regex")


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on, in turn."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + n for n, b in enumerate(hidden)}


def _as_bytes(ids: list[int]) -> bytes:
    """Little-endian, unsigned, 32 bits each; bytes cost Python's collector nothing."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _PartIds(dict):
    """Ids of the parts of words, from the tokenizer's model when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        self.letters = _byte_letters()

    def __missing__(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        if len(self) >= MEMO_PARTS:
            self.clear()
        ids = self[part] = _as_bytes([t.id for t in self.model.tokenize(letters)])
        return ids


class WordEncoder:
    """Token ids of texts, for a tokenizer whose white space only separates:
    the ids of a text are those of its words in turn.  Arrow splits a batch
    and numbers its distinct words; only these are looked up, in a bounded
    Arrow array of known words, and the ids of all words are gathered from one
    array.  Where the tokenizer cuts words by a pattern, parts of words are
    remembered too.  Python strings are made of new words alone: the memory of
    a worker must leave room for the JVM's and the other workers'."""

    def __init__(self, path: str, end_id: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pattern = _split_pattern(conf)
        self.parts = regex.compile(pattern).findall if pattern else None
        self.added = [t["content"] for t in conf["added_tokens"]]
        self.end_id = end_id
        self._forget()

    def _forget(self) -> None:
        self.part_ids = _PartIds(self.tokenizer)
        # by place; 0 is the end id, " " is in no word and so stands for what is not looked up
        self.known = pa.array([" ", ""], pa.large_string())
        self.start, self.length, self.ids = np.array([0, 1]), np.array([1, 0]), np.array([self.end_id], "<u4")

    def _encode(self, words: list[str]) -> list[bytes]:
        out: list = [None] * len(words)
        rest = []
        parts, part_ids = self.parts, self.part_ids
        joined = "\n".join(words)
        added = [a for a in self.added if a in joined]
        for k, w in enumerate(words):
            if parts and w.isprintable() and (w.isascii() or max(w) < PLAIN) and not (added and any(a in w for a in added)):
                out[k] = b"".join([part_ids[p] for p in parts(w.lower())])
            else:
                rest.append(k)
        for at in range(0, len(rest), ENCODE_WORDS):
            own = rest[at : at + ENCODE_WORDS]
            for k, e in zip(own, self.tokenizer.encode_batch([words[k] for k in own], add_special_tokens=False), strict=True):
                out[k] = _as_bytes(e.ids)
        return out

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words, encoding those not known."""
        words = words.cast(pa.large_string())
        places = pc.index_in(words, self.known)
        new = words.filter(places.is_null())
        places = pc.fill_null(places, -1).to_numpy().astype(np.int64)
        if len(new):
            encoded = self._encode(new.to_pylist())
            length = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
            start = len(self.ids) + np.cumsum(length) - length
            places[places < 0] = len(self.start) + np.arange(len(new))
            self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(encoded), "<u4")])
            self.known = pa.concat_arrays([self.known, pc.if_else(pc.greater(pc.utf8_length(new), LONG_WORD), " ", new)])
        return places

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the end id behind each, and each text's first place."""
        if len(self.start) > MEMO_WORDS or len(self.ids) > 8 * MEMO_WORDS:
            self._forget()
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        places = self._numbers(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
        ends = lists.offsets.to_numpy()[1:].astype(np.int64)
        places = np.insert(places, ends, 0)
        length = self.length[places]
        bounds = np.concatenate([[0], np.cumsum(length)])
        out = np.empty(int(bounds[-1]), "<u4")
        for at in range(0, len(places), BLOCK_WORDS):
            own = slice(at, at + BLOCK_WORDS)
            first, last = bounds[at], bounds[min(at + BLOCK_WORDS, len(places))]
            out[first:last] = self.ids[np.repeat(self.start[places[own]] - bounds[:-1][own], length[own]) + np.arange(first, last)]
        return out, np.concatenate([[0], bounds[ends + np.arange(1, len(ends) + 1)]])


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in turn, about BATCH_BYTES of text at a time."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        read = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, read + BATCH_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of ``docs``."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("ids", T.BinaryType())] if keep_ids else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_by_process(("packing", tokenizer, end_id), lambda: WordEncoder(tokenizer, end_id))
        for whole in batches:
            for b in _slices(whole, 1):
                ids, bounds = encode(b.column(1))
                size = np.diff(bounds)
                parts = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                places = np.concatenate([[0], np.cumsum(length)])
                raw = memoryview(ids).cast("B")
                cut = [raw[4 * i : 4 * j] for i, j in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
                columns = [
                    b.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(c) for c in cut], pa.int64()), *([pa.array(map(bytes, cut), pa.binary())] if keep_ids else []),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
                pa.default_memory_pool().release_unused()  # else the worker keeps all it ever held

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class RoomTree:
    """Segment tree over rooms 0..capacity; a node counts the open bins below."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, bin_id: int) -> None:
        self.bins[room].append(bin_id)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of the least room >= need."""
        node = need + self.leaves
        if not self.count[node]:
            # up to the first subtree on the right that has bins, then down its left edge
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        room = node - self.leaves
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length."""
    tree, used = RoomTree(capacity), 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        found = tree.take(n)
        if found is None:
            room, own = capacity, used
            used += 1
        else:
            room, own = found
        where[k], offset[k] = own, capacity - room
        if room > n:
            tree.put(room - n, own)
    return where, offset


def pack(rows: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``rows`` (staged; with a ``length`` of 1 to capacity) with sequence_id
    and offset added."""
    shards = max(1, -(-rows.count() // shard_pieces))
    shard = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    names = rows.columns
    at = names.index("length")
    fields = [T.StructField(str(i), f.dataType) for i, f in enumerate(rows.schema)]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key, group):
        where, offset = best_fit_decreasing(group.column(at).to_numpy(), capacity)
        group = group.select(range(len(names)))
        return group.append_column("sequence_id", pa.array((key[0].as_py() << 32) + where)).append_column("offset", pa.array(offset))

    dealt = rows.toDF(*[str(i) for i in range(len(names))]).withColumn("__shard", shard)
    return dealt.groupBy("__shard").applyInArrow(run, schema).toDF(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    return pack(staged(pieces(docs, tokenizer, capacity, keep_ids=keep_ids), "packing-pieces"), capacity)
