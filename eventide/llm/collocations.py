"""Phrase collocations by SON partitioning.

1. The corpus is dealt into ``SHARDS`` shards (a scan's partitions in turn).
   Each shard is mined completely: every phrase of 1 to ``max_words`` words is
   counted in blocks of text, and the counts of a shard are added up by hash
   range.  The local support is the global one divided by the shards: a phrase
   below it in every shard is below the global support in sum, so the union of
   the locally frequent phrases misses none.  (The support of 10 is absolute;
   more shards would bring the local one to 1, where nothing is pruned.)
2. The union is kept as a bit table of fixed size over 64-bit phrase hashes; it
   may hold too much, never too little.  All texts are read again and the
   phrases in the table are counted exactly, as words and not as hashes.
3. Scores, nested phrases and ranks are joins of the frequent phrases.

Sub-phrases of a frequent phrase are frequent themselves, so the counts of all
parts of a cut are in the same table.

Defined results: a null text has no words, a null lang is ``und``; a lang
without frequent phrases has no rows; an empty table gives no rows; repeated
rows count each; ties go to the cut with fewer words and to the phrase that is
first in UTF-8 order; texts are read whole, those longer than a block in
several stretches that overlap by ``max_words - 1`` words; other columns are
not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import join_split, staged

SUPPORT = 10
MAX_WORDS = 3
NESTED_PERCENT = 50
TOP = 2000
SHARDS = 4
NO_LANG = "und"
FILTER_BITS = 1 << 27  # bits of the candidate table: 16 MB
BLOCK_BYTES = 4 << 20  # text counted at a time
BLOCK_WORDS = (1 << 21) - 8  # three word numbers fit 63 bits
RANGE_BYTES = 4 << 20  # text whose phrases one hash range holds, about

#: Byte classes: 0 in a word, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashes(values: pa.Array, seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(v, seed) for v in values.to_pylist()), np.uint64, len(values))


class Block:
    """Words of some texts: ``words`` and ``langs`` are the distinct ones,
    ``ids`` numbers the distinct (lang, word) pairs of each place, ``piece``
    tells pieces apart."""

    def __init__(self, words: pa.Array, lang: np.ndarray, langs: pa.Array, piece: np.ndarray):
        coded = words.dictionary_encode()
        pairs = lang * len(coded.dictionary) + coded.indices.to_numpy()
        pairs, first, self.ids = np.unique(pairs, return_index=True, return_inverse=True)
        self.pair_word = coded.dictionary.take(coded.indices.take(pa.array(first)))
        self.pair_lang = langs.take(pa.array(lang[first]))
        lang_hash = _hashes(langs, 1)[lang[first]]
        self.pair_hash = _mix(_hashes(self.pair_word, 2) + lang_hash)
        self.piece, self.langs, self.lang = piece, langs, lang

    def phrases(self, n: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, counts): one place of each distinct phrase of ``n`` words
        that starts at one of the first ``starts`` words, and how many do."""
        upto = min(starts, len(self.ids) - n + 1)
        if upto <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        whole = np.flatnonzero(self.piece[:upto] == self.piece[n - 1 : n - 1 + upto])
        key = self.ids[whole].astype(np.int64)
        for k in range(1, n):
            if k % 3 == 0:  # three numbers fill a key: number the keys anew
                key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            key = (key << 21) | self.ids[whole + k]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        return whole[first], count

    def hashed(self, places: np.ndarray, n: int) -> np.ndarray:
        h = self.pair_hash[self.ids[places]]
        for k in range(1, n):
            h = _mix(h * np.uint64(3) + self.pair_hash[self.ids[places + k]])
        return h

    def spelled(self, places: np.ndarray, n: int) -> pa.Array:
        parts = [self.pair_word.take(pa.array(self.ids[places + k])) for k in range(n)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())


def _blocks(batch: pa.RecordBatch, overlap: int) -> Iterator[tuple[Block, int]]:
    """(block, starts): the words of a batch of (lang, text), the last of them
    only read on to by phrases that start before."""
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    row = 0
    while row < batch.num_rows:
        upto = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + BLOCK_BYTES, "right")))
        part = batch.slice(row, upto - row)
        row = upto
        text = pa.concat_arrays([pc.fill_null(part.column(1), "").cast(pa.large_binary())])
        _, offsets, data = text.buffers()
        offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        if offsets[0] == offsets[-1]:
            continue
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = _CLASS[data]
        inside = kind == 0
        begin = np.zeros(len(data) + 1, bool)  # a text begins here
        begin[offsets] = True
        starts = inside & begin[:-1]
        starts[1:] |= inside[1:] & ~inside[:-1]
        stops = inside & begin[1:]
        stops[:-1] |= inside[:-1] & ~inside[1:]
        starts, stops = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        if not len(starts):
            continue
        doc = np.searchsorted(offsets, starts, "right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int32)[starts]
        piece = breaks + doc
        at = np.concatenate([[0], np.cumsum(stops - starts)])
        letters = _LOWER[data[inside]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)])
        coded = pc.fill_null(part.column(0), NO_LANG).cast(pa.binary()).dictionary_encode()
        lang = coded.indices.to_numpy().astype(np.int64)[doc]
        for s in range(0, len(starts), BLOCK_WORDS - overlap):
            e = min(s + BLOCK_WORDS, len(starts))
            yield Block(words.slice(s, e - s), lang[s:e], coded.dictionary, piece[s:e]), min(e - s, BLOCK_WORDS - overlap)


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))


def candidates(texts: DataFrame, support: int, max_words: int, shards: int = SHARDS) -> DataFrame:
    """(position): places in the bit table of all phrases that are locally
    frequent in some shard."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, (int(size) // RANGE_BYTES).bit_length())

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        for batch in batches:
            for block, starts in _blocks(batch, max_words - 1):
                keys, counts = [], []
                for n in range(1, max_words + 1):
                    places, count = block.phrases(n, starts)
                    keys.append(block.hashed(places, n))
                    counts.append(count)
                keys, counts = np.concatenate(keys), np.concatenate(counts)
                order = np.argsort(keys)
                keys, counts = keys[order], counts[order]
                top = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                used, first = np.unique(top, return_index=True)
                cut = pa.array(np.append(first, len(keys)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used),
                        pa.array(np.full(len(used), shard, np.int32)),
                        pa.ListArray.from_arrays(cut, pa.array(keys.view(np.int64))),
                        pa.ListArray.from_arrays(cut, pa.array(np.minimum(counts, support).astype(np.int32))),
                    ],
                    names=["hash_range", "shard", "keys", "counts"],
                )

    def frequent(_, group):
        shard = group.column("shard").to_numpy()
        keys, counts = group.column("keys").combine_chunks(), group.column("counts").combine_chunks()
        found = []
        for s in np.unique(shard):
            mine = pa.array(np.flatnonzero(shard == s))
            key, where = np.unique(keys.take(mine).flatten().to_numpy(), return_inverse=True)
            total = np.bincount(where, counts.take(mine).flatten().to_numpy(), len(key))
            found.append(key[total * shards >= support])
        key = np.unique(np.concatenate(found)).view(np.uint64)
        return pa.table({"position": (key % np.uint64(FILTER_BITS)).astype(np.int64)})

    local = texts.mapInArrow(mine, "hash_range long, shard int, keys array<long>, counts array<int>")
    return local.groupBy("hash_range").applyInArrow(frequent, "position long")


def bit_table(positions: DataFrame) -> np.ndarray:
    """The positions as ``FILTER_BITS`` bits; that is all the driver gets."""
    one = F.col("position")
    rows = positions.groupBy(F.bitmap_bucket_number(one).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))
    table = np.zeros(FILTER_BITS // 8 + 8192, np.uint8)
    # bucket k holds positions 32768 * (k - 1) + 1 and up; bit 0 of the first byte is the first
    for k, bits in rows.toLocalIterator():
        at = 4096 * k
        table[at : at + 4096] = np.frombuffer(bits, np.uint8)
    return table


def bit_address(positions: np.ndarray) -> np.ndarray:
    """Where ``bit_table`` has a position, as Spark's bitmap functions deal
    them: bucket 1 + (p - 1) / 32768 and bit (p - 1) % 32768 for p > 0; bucket
    -p / 32768 and bit -p % 32768, which is 0 and 0, for p = 0."""
    return np.where(positions > 0, 32768 + positions - 1, 0)


def exact_counts(texts: DataFrame, table: np.ndarray, support: int, max_words: int) -> DataFrame:
    """(lang, words, phrase, a) of the frequent phrases; with words 0 and an
    empty phrase, the number of words of a lang."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value

        def rows(lang, n, phrase, number):
            return pa.RecordBatch.from_arrays(
                [lang.cast(pa.string()), pa.array(np.full(len(number), n, np.int32)), phrase.cast(pa.string()), pa.array(number.astype(np.int64))],
                names=["lang", "words", "phrase", "a"],
            )

        for batch in batches:
            for block, starts in _blocks(batch, max_words - 1):
                number = np.bincount(block.lang[:starts], minlength=len(block.langs))
                yield rows(block.langs, 0, pa.array([""] * len(number)), number)
                for n in range(1, max_words + 1):
                    places, number = block.phrases(n, starts)
                    at = bit_address((block.hashed(places, n) % np.uint64(FILTER_BITS)).astype(np.int64))
                    found = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    places, number = places[found], number[found]
                    yield rows(block.pair_lang.take(pa.array(block.ids[places])), n, block.spelled(places, n), number)

    counted = texts.mapInArrow(count, "lang string, words int, phrase string, a long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a")).where((F.col("words") == 0) | (F.col("a") >= support))


def _join(words: Column) -> Column:
    return F.array_join(words, " ")


def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(38,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of the phrases of two words or
    more in ``counts`` (staged): the cut with the lowest score."""
    w = F.split("phrase", " ")
    cut = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"), _join(F.slice(w, F.lit(1), k)).alias("left"), _join(F.slice(w, k + 1, F.col("words"))).alias("right")),
    )
    cuts = counts.where("words > 1").select("lang", "words", "phrase", "a", F.explode(cut).alias("c")).select("lang", "words", "phrase", "a", "c.*")
    parts = counts.where("words > 0")
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    cuts = staged(join_split(staged(cuts, "phrase-cuts"), left, ["lang", "left"]), "phrase-left")
    cuts = join_split(cuts, right, ["lang", "right"])
    for c in ("a", "l", "r"):
        cuts = cuts.withColumn(f"w{c}", _wide(c))
    cuts = cuts.withColumn("score", F.expr("CAST((CAST(1000000 AS DECIMAL(38,0)) * wa * wa) DIV (wl * wr) AS BIGINT)"))
    lowest = cuts.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return lowest.select("lang", "words", "phrase", "a", "m.l", "m.r", "m.score")


def nested(counts: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of the phrases inside a longer one that is at least
    ``percent`` of a hundred as frequent."""
    w, n = F.split("phrase", " "), F.col("words")
    inner = F.flatten(
        F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: _join(F.slice(w, i, k))))
    )
    longer = counts.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    both = most.join(counts.where("words > 1").select("lang", "phrase", "a"), ["lang", "phrase"])
    return both.where(F.col("longer") * 100 >= F.col("a") * percent).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    support: int = SUPPORT,
    max_words: int = MAX_WORDS,
    nested_percent: int = NESTED_PERCENT,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first ``top`` of a lang."""
    spark: SparkSession = docs.sparkSession
    texts = _texts(docs, lang, text)
    found = staged(candidates(texts, support, max_words), "phrase-candidates")
    counts = staged(exact_counts(texts, bit_table(found), support, max_words), "phrase-counts")
    all_scored = staged(scored(counts), "phrase-scores")
    own = all_scored.join(nested(counts, nested_percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = own.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    words = counts.where("words = 0").select("lang", F.col("a").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
