"""Removal of passages that an earlier document already has.

A word goes if one of the windows of ``WINDOW`` words that cover it also
starts in a document with a smaller doc_id.

1. Anchors.  Every window has one anchor: the ``ANCHOR``-word phrase in it
   with the least hash.  Equal windows have equal anchors, and neighbouring
   windows mostly share theirs, so about a fifth as many rows as words are
   shuffled.  Anchors of a single document are done with.
2. Passages.  For the anchors that recur, the stretch of words whose windows
   have that anchor is cut out of its document and dealt to a shard by anchor;
   the stretches of a frequent anchor are dealt over several.
3. Automata.  Each shard confirms which of its windows recur, compiles an
   Aho-Corasick automaton of them (phrases of ``PHRASE`` words are its symbols)
   that knows each window's first document, and streams its stretches through
   it to locate every occurrence.  Phrases are numbered by the words
   themselves, not by hashes.
4. For anchors dealt over several shards, the occurrences in the first
   document of each are compared once more by window, over all shards.

Defined results: null texts have no words; documents shorter than a window
lose nothing; rows with equal doc_id never remove each other's words; a null
doc_id counts as larger than any other; an empty table gives no rows; only
doc_id and text are read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import release, staged

WINDOW = 13
ANCHOR = 5
SLICE_BYTES = 1 << 19  # text hashed at a time
SHARD_ROWS = 20_000
NO_ID = (1 << 63) - 1

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

PHRASE = 8  # words of a symbol of the automata
BASE = 256  # digits of its number

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The words of a slice of texts, found in its bytes: ``start`` and ``end``
    in ``raw``, ``doc`` (number of the text), and ``first``, the number of each
    text's first word, with the number of words last."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        offsets, data = texts.buffers()[1:]
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
        at = at - at[0]
        inside = ~BLANKS[self.raw]
        edge = np.zeros(len(inside) + 1, bool)
        edge[at] = True
        before, after = inside[:-1] & ~edge[1:-1], inside[1:] & ~edge[1:-1]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~before
        closes[:-1] &= ~after
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def line(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one blank after each, and where each begins and ends."""
        size = self.end - self.start + 1
        end = np.cumsum(size)
        out = np.append(self.raw, np.uint8(0x20))[_ranges(self.start, size)]
        out[end - 1] = 0x20
        return out, end - size, end - 1


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of start[k] .. start[k] + size[k] - 1, for each k."""
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)


def _strings(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """Strings of these sizes, one after the other in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data))


class Phrases:
    """Hashes of word phrases of a slice of documents, by running sums over
    its bytes: a phrase's hash does not depend on where it stands."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, SLICE_BYTES * 2), _powers(_INVERSE, SLICE_BYTES * 2)

    def hashes(self, words: Words, size: int) -> np.ndarray:
        """Hash of the phrase of ``size`` words from each word on."""
        n = len(words.start) - size + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        if len(words.raw) >= len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(words.raw)), _powers(_INVERSE, 2 * len(words.raw))
        total = np.zeros(len(words.raw) + 1, np.uint64)
        np.cumsum((words.raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(words.raw)], out=total[1:])
        own = (total[words.end] - total[words.start]) * self.down[words.start]
        own ^= own >> np.uint64(31)
        h = own[:n].copy()
        for k in range(1, size):
            h = h * np.uint64(_BASE) + own[k : k + n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h

    def stretches(self, words: Words) -> tuple[np.ndarray, ...]:
        """(anchor hash, document, first window, last window) of the runs of
        windows that share an anchor; windows are numbered within documents."""
        h, doc = self.hashes(words, ANCHOR), words.doc
        window = np.flatnonzero(doc[: max(0, len(doc) - WINDOW + 1)] == doc[WINDOW - 1 :])
        if not len(window):
            none = np.zeros(0, np.int64)
            return none, none, none, none
        near = np.lib.stride_tricks.sliding_window_view(h, WINDOW - ANCHOR + 1)
        at = window + near[window].argmin(axis=1)
        new = np.ones(len(window), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[window[1:]] != doc[window[:-1]])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(window)) - 1
        own = doc[window[begin]]
        return h[at[begin]].view(np.int64), own, window[begin] - words.first[own], window[last] - words.first[own]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Consecutive rows and their words, about SLICE_BYTES of text at a time."""
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size, dtype=np.int64)
    at = 0
    while at < len(end):
        to = min(len(end), int(np.searchsorted(end, (end[at - 1] if at else 0) + SLICE_BYTES)) + 1)
        part = batch.slice(at, to - at)
        yield part, Words(part.column(column))
        at = to


def _anchors(docs: DataFrame) -> DataFrame:
    """(h, doc_id), once for each slice of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases()
        for b in batches:
            for part, words in _slices(b, 2):
                h, doc, _, _ = phrases.stretches(words)
                ids = part.column(0).to_numpy()[doc]
                order = np.lexsort((ids, h))
                h, ids = h[order], ids[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(ids[new])], names=["h", "doc_id"])

    return docs.mapInArrow(run, "h bigint, doc_id bigint")


def _stretches(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases()
        for b in batches:
            for part, words in _slices(b, 2):
                h, doc, first, last = phrases.stretches(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(part.column(1).to_numpy()[doc]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    names=["h", "uid", "first", "last"],
                )

    return docs.mapInArrow(run, "h bigint, uid bigint, first int, last int")


def _cut_out(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, salted, doc_id, uid, firsts, words): the stretches' text; equal
    stretches of a row are one, with all their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in _slices(b, 2):
                line, begin, end = words.line()
                spans = part.column(3)
                first, last, h, salts = (c.to_numpy() for c in spans.flatten().flatten())
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(spans).fill_null(0).to_numpy(zero_copy_only=False))
                left = begin[words.first[row] + first]
                size = end[words.first[row] + last + WINDOW - 1] - left
                texts = _strings(line[_ranges(left, size)], size)
                same = texts.dictionary_encode()
                key = row * len(same.dictionary) + same.indices.to_numpy()
                _, one, which = np.unique(key, return_index=True, return_inverse=True)
                places = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(one)))]).astype(np.int32)
                firsts = pa.ListArray.from_arrays(pa.array(places), pa.array(first[np.argsort(which, kind="stable")].astype(np.int32)))
                h, salts, row = h[one], salts[one].astype(np.int64), row[one]
                uid = part.column(1).to_numpy()[row]
                columns = [pa.array(h % shards + shards * (uid % salts)), pa.array(salts > 1), pa.array(part.column(0).to_numpy()[row]), pa.array(uid), firsts, texts.take(pa.array(one))]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "salted", "doc_id", "uid", "firsts", "words"])

    return docs.select("doc_id", "uid", "text", "spans").mapInArrow(
        run, "shard bigint, salted boolean, doc_id bigint, uid bigint, firsts array<int>, words string"
    )


def _numbered(values: np.ndarray) -> np.ndarray:
    """Equal numbers from 0 for equal values."""
    return pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)


def _phrases(ids: np.ndarray, have: int, size: int) -> np.ndarray:
    """Numbers of the phrases of ``size`` words from each word on, from those
    of ``have`` words: equal phrases, and only they, have equal numbers."""
    while have < size:
        step = min(have, size - have)
        ids = _numbered(ids[:-step] << 32 | ids[step:])
        have += step
    return ids


def _symbols(ids: np.ndarray) -> tuple[str, int]:
    """The numbers as text of a fixed width, in digits of BASE; the digit that
    comes first has symbols of its own, so no match begins inside a number.
    A node of the automaton is searched child by child: few symbols keep it
    fast, however many phrases there are."""
    width = 1
    while BASE**width <= int(ids.max(initial=0)):
        width += 1
    digits = np.stack([ids // BASE**k % BASE + 1 + (BASE if k == 0 else 0) for k in range(width)], axis=1)
    return digits.astype("<u4").tobytes().decode("utf-32-le"), width


def _locate(table):
    """One shard: ranges of windows (a to b) that occur in an earlier document,
    and, of salted anchors, the windows of the first documents.  Copies of a
    stretch are read once."""
    import ahocorasick

    encoded = table.column("words").combine_chunks().dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    which, texts = encoded.indices.to_numpy(), encoded.dictionary
    ids, uids = table.column("doc_id").to_numpy(), table.column("uid").to_numpy()
    least, most = np.full(len(texts), NO_ID), np.full(len(texts), -NO_ID - 1)
    np.minimum.at(least, which, ids)
    np.maximum.at(most, which, ids)
    words = pc.split_pattern(texts, " ")
    edges = words.offsets.to_numpy().astype(np.int64)
    phrases = _phrases(words.values.dictionary_encode().indices.to_numpy().astype(np.int64), 1, PHRASE)
    windows = _phrases(phrases, PHRASE, WINDOW)
    # every line has a window at least; those across two lines are none
    per_line = np.diff(edges) - WINDOW + 1
    line, at = np.repeat(np.arange(len(texts)), per_line), _ranges(edges[:-1], per_line)
    windows = _numbered(windows[at])
    n = int(windows.max(initial=-1)) + 1
    first_doc, last_doc, place = np.full(n, NO_ID), np.full(n, -NO_ID - 1), np.zeros(n, np.int64)
    np.minimum.at(first_doc, windows, least[line])
    np.maximum.at(last_doc, windows, most[line])
    place[windows] = at

    # the automaton of the recurring windows reads the lines, as phrases
    text, width = _symbols(phrases)
    machine, long = ahocorasick.Automaton(), WINDOW - PHRASE + 1
    again = np.flatnonzero(first_doc < last_doc)
    for x, earliest in zip((place[again] * width).tolist(), first_doc[again].tolist(), strict=True):
        machine.add_word(text[x : x + long * width], earliest)
    found: list[tuple[int, int]] = []
    count = np.zeros(len(texts), np.int64)
    if len(again):
        machine.make_automaton()
        for k, (x, y) in enumerate(zip((edges[:-1] * width).tolist(), ((edges[1:] - PHRASE + 1) * width).tolist(), strict=True)):
            before = len(found)
            found.extend(machine.iter(text[x:y]))
            count[k] = len(found) - before
    del machine
    hits = np.array(found, np.int64).reshape(-1, 2)
    where, earliest = (hits[:, 0] + 1) // width - long, hits[:, 1]

    # hits of every row, those of an earlier document; runs of neighbours are one range
    begin = np.cumsum(count) - count
    row = np.repeat(np.arange(len(which)), count[which])
    hit = _ranges(begin[which], count[which])
    own = earliest[hit] < ids[row]
    row, i = row[own], where[hit[own]]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (i[1:] != i[:-1] + 1)
    open_ = np.flatnonzero(new)
    row, low, high = row[open_], i[open_], i[np.append(open_[1:], len(i))[: len(open_)] - 1]
    # at all places of the row's stretch
    firsts = table.column("firsts").combine_chunks()
    places, many = firsts.flatten().to_numpy().astype(np.int64), pc.list_value_length(firsts).to_numpy().astype(np.int64)
    start = np.cumsum(many) - many
    shift = places[_ranges(start[row], many[row])]
    uid, low, high = (np.repeat(c, many[row]) for c in (uids[row], low, high))
    none = pa.nulls(len(uid), pa.int64()), pa.nulls(len(uid), pa.string())
    columns = ("uid", "a", "b", "doc_id", "window")
    ranges = pa.table([pa.array(uid), pa.array((shift + low).astype(np.int32)), pa.array((shift + high).astype(np.int32)), *none], names=columns)

    hot = np.flatnonzero(table.column("salted").to_numpy())
    if not len(hot):
        return ranges
    from_line = np.cumsum(per_line) - per_line
    out: list[list] = [[], [], [], []]
    for r in hot.tolist():
        k, d = which[r], int(ids[r])
        mine = slice(int(from_line[k]), int(from_line[k] + per_line[k]))
        leads = np.flatnonzero(first_doc[windows[mine]] == d).tolist()
        own_words = texts[int(k)].as_py().split(" ") if leads else []
        for i in leads:
            for x in places[start[r] : start[r] + many[r]].tolist():
                for c, v in zip(out, (int(uids[r]), x + i, d, " ".join(own_words[i : i + WINDOW])), strict=True):
                    c.append(v)
    uid, a, d, window = (pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.string()), strict=True))
    return pa.concat_tables([ranges, pa.table([uid, a, a, d, window], names=columns)])


def _recurring(docs: DataFrame, shard_rows: int) -> DataFrame:
    """(h, n, salts) of the anchors of more than one document."""
    anchors = _anchors(docs).groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / shard_rows).cast("int").alias("salts")
    return staged(anchors.where("lo < hi").select("h", "n", salts), "substrings-anchors")


def _spans(docs: DataFrame, recurring: DataFrame) -> DataFrame:
    """(uid, spans): the stretches of each row that have a recurring anchor."""
    rows = _stretches(docs).join(recurring.select("h", "salts"), "h")
    return staged(rows.groupBy("uid").agg(F.collect_set(F.struct("first", "last", "h", "salts")).alias("spans")), "substrings-spans")


def _found(docs: DataFrame, spans: DataFrame, shards: int) -> DataFrame:
    cut = _cut_out(docs.join(spans, "uid"), shards)
    return staged(cut.groupBy("shard").applyInArrow(_locate, "uid bigint, a int, b int, doc_id bigint, window string"), "substrings-found")


def removals(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(uid, ranges): ranges (a, b) of windows of a row that occur in an
    earlier document.  ``docs``: (doc_id, uid, text) without nulls."""
    spark = docs.sparkSession
    recurring = _recurring(docs, shard_rows)
    release(spark)
    rows = recurring.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-rows // shard_rows))
    spans = _spans(docs, recurring)
    release(spark)
    found = _found(docs, spans, shards)
    release(spark)
    hot = found.where("window is not null")
    least = hot.groupBy("window").agg(F.min("doc_id").alias("least"))
    across = hot.join(least, "window").where("doc_id > least").select("uid", "a", "b")
    every = found.where("window is null").select("uid", "a", "b").union(across)
    ranges = staged(every.groupBy("uid").agg(F.collect_set(F.struct("a", "b")).alias("ranges")), "substrings-ranges")
    release(spark)
    return ranges


def deduplicate(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of ``docs``; kept is the
    text of the words that stay, joined by single spaces."""
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("uid"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ranges = removals(rows)
    given = docs.select("doc_id", "text").withColumn("uid", F.xxhash64("doc_id", "text")).join(ranges, "uid", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, words in _slices(b, 1):
                line, begin, end = words.line()
                n, ranges = np.diff(words.first), part.column(2)
                low, high = (c.to_numpy() for c in ranges.flatten().flatten())
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(ranges).fill_null(0).to_numpy(zero_copy_only=False))
                # covered by as many ranges as begin before less those that ended
                change = np.zeros(len(begin) + 1, np.int64)
                np.add.at(change, words.first[row] + np.minimum(low, n[row]), 1)
                np.subtract.at(change, words.first[row] + np.minimum(high + WINDOW, n[row]), 1)
                stays = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                doc, size = words.doc[stays], end[stays] - begin[stays]
                size[:-1] += doc[:-1] == doc[1:]  # the blank before the next word
                whole = np.bincount(doc, size, part.num_rows).astype(np.int64)
                kept = _strings(line[_ranges(begin[stays], size)], whole)
                gone = n - np.bincount(doc, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), kept], names=["doc_id", "n_words", "n_removed", "kept"])

    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )
    return given.select("doc_id", "text", "ranges").mapInArrow(run, schema)

