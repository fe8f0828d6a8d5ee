"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Every text becomes a 64-bit fingerprint; equal fingerprints are one node
   from then on, so a group of copies costs one row whatever its size.
2. Bits that are correlated over the corpus are put into the same partition.
   For distance t over m partitions, thresholds t_i with sum(t_i + 1) = t + 1
   are enough: two fingerprints within t bits differ by at most t_i bits in
   some partition.  Dynamic programming allocates them to the least estimated
   cost (probe rows plus candidates), from collision counts of all
   fingerprints; m is chosen by the same cost.
3. Fingerprints that are neighbours in the sorted order of any partition are
   linked first if they are close.  That is linear, and gathers dense clouds
   of near copies.
4. Probe: each fingerprint looks up all values within t_i bits of its own, in
   every partition.  Only pairs from different components of step 3 matter
   for the result, so a lookup from the component that dominates a bucket
   skips that component's rows; a large group is thus never paired with
   itself.  Verify: the full distance is checked on every pair.

No pair within the distance is lost, whatever the sizes of the groups."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import release, staged
from eventide.llm.graph import components

BITS = 64
SEED = 42
PROBE_COST = 20  # of a probe row, which is shuffled, in comparisons of a candidate
SLICE = 1 << 16  # shingles hashed at a time


def _text_fingerprint(text: str | None, size: int) -> int:
    """Fingerprint as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    if len(words) <= size:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(size)), strict=False))
        n = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    left = n
    while left:
        part = min(left, SLICE)
        h = np.fromiter(map(xxhash.xxh64_intdigest, islice(shingles, part), repeat(SEED)), np.uint64, part)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= part
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, fp) for each row of ``docs``; words are cut at ASCII white
    space, null and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [_text_fingerprint(t.as_py(), size) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("fp", T.LongType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- plan of the search ------------------------------------------------------


@dataclass
class Search:
    parts: list[list[int]]  # bits of each partition
    limits: list[int]  # its threshold; -1: not probed
    cost: float


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, of those with both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        n = 0
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            m = np.unpackbits(x, axis=1, bitorder="little").astype(np.float64)
            both += (m.T @ m).astype(np.int64)
            n += len(x)
        i = np.arange(BITS * BITS + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.append(both.ravel(), n))], names=["i", "n"])

    # one row for each two bits: 4,097 numbers in all
    rows = fps.select("fp").mapInArrow(run, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for r in rows:
        flat[r["i"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of (nearly) equal size; each is seeded with the free bit of
    the strongest correlation and grows by the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        ids = sorted(free)
        group = [max(ids, key=lambda b: corr[b, ids].max())]
        free.discard(group[0])
        while len(group) < size:
            b = max(sorted(free), key=lambda b: corr[b, group].mean())
            group.append(b)
            free.discard(b)
        groups.append(sorted(group))
    return groups


def _distance_shares(p: np.ndarray, most: int) -> np.ndarray:
    """Share of pairs at distance 0..most in these bits, taken as independent."""
    share = np.zeros(most + 1)
    share[0] = 1.0
    for d in 2 * p * (1 - p):
        share[1:] = share[1:] * (1 - d) + share[:-1] * d
        share[0] *= 1 - d
    return share


def allocate(equal: list[float], shares: list[np.ndarray], sizes: list[int], n: int, distance: int):
    """Thresholds t_i >= -1 with sum(t_i + 1) = distance + 1 of the least
    cost, by dynamic programming.  equal: pairs of fingerprints that agree in
    a partition, counted; shares: see above."""

    def cost(i: int, t: int) -> float:
        if t < 0:
            return 0.0
        grow = shares[i][: t + 1].sum() / max(shares[i][0], 1e-18)
        balls = sum(_choose(sizes[i], k) for k in range(t + 1))
        return PROBE_COST * n * balls + min(equal[i] * grow, float(n) * n)

    best = {0: (0.0, [])}
    for i in range(len(equal)):
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, distance + 1 - used):
                new = (c + cost(i, t), [*ts, t])
                if used + t + 1 not in after or new[0] < after[used + t + 1][0]:
                    after[used + t + 1] = new
        best = after
    c, limits = best[distance + 1]
    return c, limits


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def plan_search(fps: DataFrame, distance: int, tried=(2, 3, 4, 5)) -> Search:
    """Best plan over the numbers of partitions in ``tried``."""
    n, both = bit_counts(fps)
    p = np.diag(both) / max(n, 1)
    plans = {m: group_bits(n, both, m) for m in tried}
    keys = [(m, i, _mask(bits)) for m, parts in plans.items() for i, bits in enumerate(parts)]
    values = F.explode(
        F.array(*[F.struct(F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(k)).alias("v")) for j, (_, _, k) in enumerate(keys)])
    )
    same = fps.select(values.alias("x")).groupBy("x.j", "x.v").agg(F.count("*").alias("c"))
    pairs = same.groupBy("j").agg(F.sum((F.col("c") * (F.col("c") - 1)).cast("double") / 2).alias("n"))
    equal = {(keys[r["j"]][0], keys[r["j"]][1]): r["n"] for r in pairs.collect()}
    out = None
    for m, parts in plans.items():
        shares = [_distance_shares(p[bits], distance) for bits in parts]
        cost, limits = allocate(
            [equal.get((m, i), 0.0) for i in range(m)], shares, [len(b) for b in parts], n, distance
        )
        if out is None or cost < out.cost:
            out = Search(parts, limits, cost)
    return out


# --- search ------------------------------------------------------------------


def _index(nodes: DataFrame, search: Search) -> DataFrame:
    used = [(i, _mask(b)) for i, (b, t) in enumerate(zip(search.parts, search.limits, strict=True)) if t >= 0]
    key = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in used]))
    return nodes.select(key.alias("k"), *nodes.columns).select("k.part", "k.key", *nodes.columns)


def _variant(i: int, at):
    return lambda flip: F.struct(F.lit(i).alias("part"), at.bitwiseXOR(flip).alias("key"))


def _probes(nodes: DataFrame, search: Search) -> DataFrame:
    rows = []
    for i, (bits, t) in enumerate(zip(search.parts, search.limits, strict=True)):
        flips = [_mask(c) for k in range(t + 1) for c in combinations(bits, k)]
        if flips:
            at = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
            rows.append(F.transform(F.array(*map(F.lit, flips)), _variant(i, at)))
    return nodes.select(F.explode(F.concat(*rows)).alias("k"), *nodes.columns).select("k.part", "k.key", *nodes.columns)


def _neighbour_links(fps: DataFrame, search: Search, distance: int) -> DataFrame:
    """Edges between fingerprints next to each other in the order (partition's
    value, rest).  Range partitioning cuts large buckets; what a cut hides is
    left to the probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros(0, np.uint64)
        for b in batches:
            x = np.concatenate([last, b.column(2).to_numpy().view(np.uint64)])
            last = x[-1:]
            close = np.bitwise_count(x[1:] ^ x[:-1]) <= distance
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[1:][close].view(np.int64)), pa.array(x[:-1][close].view(np.int64))], names=["a", "b"]
            )

    whole = Search(search.parts, [0] * len(search.parts), 0)
    rows = _index(fps.select("fp"), whole).select("part", "key", "fp")
    return rows.repartitionByRange("part", "key", "fp").sortWithinPartitions("part", "key", "fp").mapInArrow(
        run, "a bigint, b bigint"
    ).where("a <> b")


def near_links(nodes: DataFrame, search: Search, distance: int) -> DataFrame:
    """All pairs (a, b) within ``distance`` whose components differ.
    ``nodes``: (fp, comp), one row for each fingerprint."""
    index = _index(nodes, search)
    bucket = (
        index.groupBy("part", "key", "comp").agg(F.count("*").alias("n"))
        .groupBy("part", "key").agg(F.max(F.struct("n", "comp")).alias("top"))
        .select("part", "key", F.col("top.comp").alias("top"))
    )
    probes = _probes(nodes, search).select("part", "key", F.col("fp").alias("a"), F.col("comp").alias("ca"))
    probes = probes.join(bucket, ["part", "key"])
    rows = index.select("part", "key", F.col("fp").alias("b"), F.col("comp").alias("cb"))
    close = (F.col("ca") != F.col("cb")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    outside = probes.where("ca <> top").drop("top").join(rows, ["part", "key"]).where(close)
    rest = rows.join(bucket, ["part", "key"]).where("cb <> top").drop("top")
    inside = probes.where("ca = top").drop("top").join(rest, ["part", "key"]).where(close)
    return outside.union(inside).select("a", "b").distinct()


def classes(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Add ``component_id`` (the smallest doc_id reachable over links of at
    most ``distance`` bits) to ``prints(doc_id, fp)``, staged by the caller."""
    spark = prints.sparkSession
    fps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    search = plan_search(fps, distance)
    found = staged(_neighbour_links(fps, search, distance).distinct(), "simhash-links")
    comp = staged(components(found, "simhash-components"), "simhash-near")
    nodes = staged(
        fps.select("fp").join(comp, fps["fp"] == comp["node"], "left").select("fp", F.coalesce("root", "fp").alias("comp")),
        "simhash-nodes",
    )
    release(spark)
    links = staged(near_links(nodes, search, distance), "simhash-links")
    # components of step 3 are contracted; only their roots are linked on
    root = nodes.select(F.col("fp"), F.col("comp"))
    across = (
        links.join(root.select(F.col("fp").alias("a"), F.col("comp").alias("ra")), "a")
        .join(root.select(F.col("fp").alias("b"), F.col("comp").alias("rb")), "b")
        .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    )
    top = staged(components(across, "simhash-components"), "simhash-roots")
    final = nodes.join(top, nodes["comp"] == top["node"], "left").select("fp", F.coalesce("root", "comp").alias("comp"))
    final = final.join(fps, "fp")
    least = final.groupBy("comp").agg(F.min("first").alias("component_id"))
    final = staged(final.join(least, "comp").select("fp", "component_id"), "simhash-classes")
    release(spark)
    return prints.join(final, "fp")


def near_duplicates(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id), one row for each row of ``docs``.

    Null and blank texts have fingerprint 0 and link like any other; repeated
    rows give repeated rows; a null doc_id is never the smallest unless all of
    a class are null; an empty table gives no rows; further columns of
    ``docs`` are not read."""
    prints = staged(fingerprints(docs, size), "simhash-docs")
    return classes(prints, distance)


def _row_key() -> Column:
    """Key of a row by doc_id and text; the length parts the two, null and
    blank texts of an id are equal, a null doc_id equals no other."""
    doc_id = F.col("doc_id").cast("string")
    return F.md5(F.concat(F.coalesce(F.concat(F.length(doc_id), F.lit(":"), doc_id), F.lit("-")), F.coalesce("text", F.lit(""))))


def one_of_each(docs: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """One row of ``docs`` for each class: the row with the smallest doc_id, a
    null one only if all of the class are null, and of equal doc_ids the one
    with the smallest row key.  Rows with equal doc_ids and different texts
    are different rows."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _row_key().alias("key"))
    found = near_duplicates(docs.select(row.alias("doc_id"), "text"), size, distance)
    keep = found.select(F.col("component_id.key").alias("__keep_key")).distinct()
    kept = docs.withColumn("__keep_key", _row_key()).join(keep, "__keep_key").dropDuplicates(["__keep_key"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
