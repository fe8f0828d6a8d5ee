"""Toxicity with a subsequence string kernel, Nystroem landmarks and a linear
support vector machine.

The kernel compares two strings by their common subsequences of four letters;
a subsequence that spans s characters weighs DECAY**s, and spans longer than
``SPAN`` are not counted, so inserted characters and gaps weaken an insult's
match but do not break it.  Landmarks are the words that tell toxic from clean
training documents best, and frequent clean words.  A machine over Nystroem
features is linear in kernel values, f(x) = sum_j b_j K(x, landmark_j), and K
is linear in the subsequences of x: f is one weight for each subsequence.
Scoring is therefore exact and needs one table look-up for each of the 20
position patterns of a four-letter subsequence at each character.

A document is judged by the largest margins of its windows of ``WINDOW``
characters; a logistic curve turns them into a probability.

What is learnt: word counts by label over *all* labelled training rows give
the landmarks; the machine and the curve are fitted on labelled sentences of a
bounded sample of training rows (``MAX_DOCS`` documents by hash order, see
``fit``).

Defined results: null and empty texts have no subsequences and get the
curve's value at 0; equal texts get equal scores; without any labelled row of
both kinds every score is the share of toxic labels (0 without labels); rows
without a doc_id are scored but have no label; only doc_id and text are read.
Letters of other alphabets are symbols by their number, whole texts count."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import staged

LETTERS = 4
SPAN = 7
DECAY = 0.6
WINDOW = 24
SYMBOLS = 32
PEAKS = 3  # windows of a document that its score looks at
FLOOR = 0.0
SLICE = 1 << 18  # characters scored at a time

# bounds of the sample that the machine is fitted on
LANDMARKS = 64  # clean stems at most; of toxic ones all that pass the test
FALSE = 0.1  # expected share of landmarks that are telling by chance only
BINS, TOP = 20, 100.0  # bins a nat, and most evidence told apart, in the test
MAX_DOCS = 4000  # labelled documents
MAX_SENTENCES = 40  # of each
STEM = 8  # characters of a word that a landmark has at most

#: Position patterns of a subsequence from its first character, with weights.
PATTERNS = [(0, *c) for c in combinations(range(1, SPAN), LETTERS - 1)]
WEIGHTS = [DECAY ** (p[-1] + 1 - LETTERS) for p in PATTERNS]


OTHER = 27


def _fold_table() -> np.ndarray:
    """Characters to symbols: 1..26 letters without accents and case, OTHER
    anything else; digits and signs that stand for letters are read so, and
    letters of other alphabets take the symbols in turn."""
    import unicodedata

    out = np.full(1 << 16, OTHER, np.uint8)
    alike = dict(zip("013457@$", "oieastas", strict=True))
    for c in range(len(out)):
        ch = unicodedata.normalize("NFKD", chr(c).lower())[:1]
        ch = alike.get(ch, ch)
        if "a" <= ch <= "z":
            out[c] = ord(ch) - 96
        elif ch.isalpha():
            out[c] = 1 + ord(ch) % 26
    return out


FOLD = _fold_table()


def codes(text: str | None) -> np.ndarray:
    """Symbols of a text; each run of other characters is one symbol, and none
    between letters that stand alone."""
    points = np.frombuffer(f" {text or ''} ".encode("utf-32-le", "surrogatepass"), "<u4")
    raw = FOLD[np.minimum(points, len(FOLD) - 1)]
    far = points >= len(FOLD)
    if far.any():
        raw[far] = 1 + points[far] % 26
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != OTHER) | (raw[:-1] != OTHER)
    x = raw[keep]
    # letters that stand alone in a row are read as one word
    other = x == OTHER
    single = np.zeros(len(x), bool)
    single[1:-1] = ~other[1:-1] & other[:-2] & other[2:]
    drop = np.zeros(len(x), bool)
    drop[1:-1] = other[1:-1] & single[:-2] & single[2:]
    return x[~drop]


def _letter_numbers(x: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """For each position pattern: numbers of the subsequences that start at
    each position (0 where a symbol is no letter), and the weight."""
    n = len(x)
    wide = np.concatenate([x, np.full(SPAN, OTHER, np.uint8)])
    letter = wide != OTHER
    value = np.where(letter, wide, 0).astype(np.int32)
    for p, weight in zip(PATTERNS, WEIGHTS, strict=True):
        a, b, c, d = (value[k : k + n] for k in p)
        ok = letter[:n] & letter[p[1] : p[1] + n] & letter[p[2] : p[2] + n] & letter[p[3] : p[3] + n]
        yield np.where(ok, ((a * SYMBOLS + b) * SYMBOLS + c) * SYMBOLS + d, 0), weight


def features(text: str) -> dict[int, float]:
    """Weights of all subsequences of a short text."""
    out: dict[int, float] = {}
    for numbers, weight in _letter_numbers(codes(text)):
        for k in numbers[numbers > 0].tolist():
            out[k] = out.get(k, 0.0) + weight
    return out


def kernel(a: dict[int, float], b: dict[int, float]) -> float:
    if len(a) > len(b):
        a, b = b, a
    return sum(v * b.get(k, 0.0) for k, v in a.items())


def window_values(text: str | None, table: np.ndarray) -> np.ndarray:
    """f of every window of WINDOW symbols of a text, under the weight table."""
    x = codes(text)
    best = []
    for at in range(0, max(len(x), 1), SLICE):
        part = x[at : at + SLICE + WINDOW + SPAN]
        value = np.zeros(len(part), np.float64)
        for numbers, weight in _letter_numbers(part):
            value += weight * table[numbers]
        run = np.concatenate([[0.0], np.cumsum(value)])
        best.append(run[min(WINDOW, len(run) - 1) :] - run[: max(len(run) - WINDOW, 1)])
    return np.concatenate(best)


def peaks(text: str | None, table: np.ndarray, bias: float) -> np.ndarray:
    """The PEAKS largest margins of a text's windows, from windows that do not
    overlap; FLOOR where there are no more."""
    value = window_values(text, table) + bias
    out = np.full(PEAKS, FLOOR)
    for k in range(PEAKS):
        at = int(value.argmax())
        if value[at] <= FLOOR:
            break
        out[k] = value[at]
        value[max(0, at - WINDOW) : at + WINDOW + 1] = FLOOR
    return out


@dataclass
class Model:
    table: np.ndarray  # weight of each subsequence
    bias: float
    slopes: np.ndarray  # of the peaks
    shift: float

    def score(self, text: str | None) -> float:
        z = float(peaks(text, self.table, self.bias) @ self.slopes) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _constant(share: float) -> Model:
    odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
    return Model(np.zeros(SYMBOLS**LETTERS, np.float32), 0.0, np.zeros(PEAKS), float(odds))


def _words(text):
    """Distinct stems (first characters) of the words of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) >= LETTERS), lambda w: F.substring(w, 1, STEM)))


def _least_evidence(candidates: DataFrame, tested: int) -> float | None:
    """Evidence from which stems are landmarks, by Benjamini and Hochberg's
    step-up rule: among ``tested`` stems, at most a share of FALSE of those
    that pass is expected to be there by chance.  Counted in bins of 1 / BINS
    nats, rounded down; evidence beyond TOP passes at any size."""
    bins = candidates.groupBy(F.floor(F.least("gain", F.lit(TOP)) * BINS).alias("bin")).count().collect()
    least, passed = None, 0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        passed += r["count"]
        if tested * np.exp(-r["bin"] / BINS) <= FALSE * passed:
            least = r["bin"] / BINS
    return least


def _identity(docs: DataFrame) -> DataFrame:
    """``docs`` with 128 bits of its text's hashes, which stand for the text in shuffles."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "text", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))


def landmark_words(docs: DataFrame, keys: DataFrame, n: int = LANDMARKS) -> tuple[list[str], list[str]]:
    """All stems that are telling of toxic documents, the most telling first,
    and the n most frequent stems of clean ones, by counts of different texts
    over all rows of ``keys``, the labelled (doc_id, h1, h2, toxic) of
    ``docs``.  The texts stay where they are: one row of each text and label
    is chosen by the hashes, and only its stems are shuffled, as one line (an
    array has 16 to 24 bytes for each, whatever its length)."""
    # copies are one piece of evidence
    labelled = staged(keys.groupBy("h1", "h2", "toxic").agg(F.min("doc_id").alias("doc_id")), "toxicity-texts")
    stems = docs.select("doc_id", "h1", "h2", F.array_join(_words(F.col("text")), " ").alias("stems"))
    chosen = stems.join(labelled, ["doc_id", "h1", "h2"]).dropDuplicates(["doc_id", "h1", "h2", "toxic"])
    rows = chosen.where("stems <> ''").select("toxic", F.explode(F.split("stems", " ")).alias("w"))
    counts = staged(
        rows.groupBy("w")
        .agg(F.sum("toxic").cast("double").alias("bad"), F.sum(1 - F.col("toxic")).cast("double").alias("good")),
        "toxicity-words",
    )
    size = labelled.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    if not size["bad"] or not size["good"]:
        return [], []
    p, q = (F.col("bad") + 0.5) / (size["bad"] + 1.0), (F.col("good") + 0.5) / (size["good"] + 1.0)
    # evidence in nats, for each stem by itself: exp(-gain) bounds the chance that
    # as many of its texts are toxic if toxic texts use it like any others
    share = size["bad"] / (size["bad"] + size["good"])
    texts = F.col("bad") + F.col("good")
    clean = F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / texts / (1 - share))).otherwise(0.0)
    gain = F.col("bad") * F.log(F.col("bad") / texts / share) + clean
    telling = counts.where((F.col("bad") >= 3) & (p > 8 * q)).select("w", gain.alias("gain"))
    least = _least_evidence(telling, counts.where(texts >= 3).count())
    top = telling.where(F.col("gain") >= least).orderBy(F.desc("gain"), "w").collect() if least is not None else []
    bad = [r["w"] for r in top]
    good = [r["w"] for r in counts.where(p < 2 * q).orderBy(F.desc("good"), "w").limit(n).collect()]
    return bad, good


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 3000.0, steps: int = 60) -> np.ndarray:
    """Linear machine with squared hinge loss and a bias (last column), by
    Newton's method on the support vectors; classes weigh alike."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        inside = y * (x @ w) < 1
        sv, c = x[inside], cost * weight[inside] / len(y)
        new = np.linalg.solve(ridge + 2 * (sv.T * c) @ sv, 2 * (sv.T * c) @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[np.ndarray, float]:
    """Slopes (not below zero) and shift of a logistic curve."""
    x = np.hstack([x, np.ones((len(x), 1))])
    used = np.ones(x.shape[1], bool)
    w = np.zeros(x.shape[1])
    while True:
        z, w = x[:, used], np.zeros(x.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
            h = (z.T * np.maximum(p * (1 - p), 1e-9)) @ z + 1e-2 * np.eye(z.shape[1])
            w[used] += np.linalg.solve(h, z.T @ (y - p) - 1e-2 * w[used])
        if (w[:-1] >= 0).all():
            return w[:-1], float(w[-1])
        used[:-1] &= w[:-1] >= 0


def _best_window(text: str, found: dict[str, float]) -> str:
    """The stretch of a sentence around its most telling landmark."""
    low = text.lower()
    at = max(((g, low.find(w)) for w, g in found.items() if w in low), default=(0, 0))[1]
    return text[max(0, at - 6) : at + WINDOW - 6]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """``docs``: (doc_id, text); ``labels``: (doc_id, toxic) of the training rows."""
    docs = _identity(docs)
    keys = staged(docs.drop("text").join(labels.where("toxic in (0, 1)").select("doc_id", "toxic"), "doc_id"), "toxicity-labelled")
    bad, good = landmark_words(docs, keys)
    share = keys.agg(F.avg("toxic")).first()[0] or 0.0
    if not bad:
        return _constant(share)
    # bounded sample: MAX_DOCS documents by hash, MAX_SENTENCES sentences of each by hash
    taken = keys.distinct().orderBy(F.xxhash64("doc_id", "h1"), "doc_id", "h2", "toxic").limit(MAX_DOCS)
    taken = F.broadcast(staged(taken, "toxicity-taken"))
    sentences = F.filter(F.split(F.coalesce("text", F.lit("")), r"[.!?\n|]+"), lambda s: F.length(s) >= LETTERS)
    sample = (
        docs.join(taken, ["doc_id", "h1", "h2"]).dropDuplicates(["doc_id", "h1", "h2", "toxic"])
        .select("doc_id", "toxic", F.slice(F.array_sort(F.transform(sentences, lambda s: F.struct(F.xxhash64(s).alias("h"), F.substring(s, 1, 400).alias("s")))), 1, MAX_SENTENCES).alias("x"))
        .select("doc_id", "toxic", F.col("x.s").alias("x"))
    )
    rows = staged(sample, "toxicity-sample").orderBy("doc_id", "toxic", "x").collect()
    landmarks = [features(w) for w in bad + good]
    landmarks = [m for m in landmarks if m]
    gram = np.array([[kernel(a, b) for b in landmarks] for a in landmarks])
    size = np.sqrt(np.diag(gram))
    gram = gram / np.outer(size, size)
    values, vectors = np.linalg.eigh(gram)
    ok = values > 1e-6 * values.max()
    root = vectors[:, ok] / np.sqrt(values[ok])  # Nystroem: K(x, L) root

    own = sorted({k for m in landmarks for k in m})
    place = np.zeros(SYMBOLS**LETTERS, np.int32)
    place[own] = np.arange(1, len(own) + 1)
    matrix = np.zeros((len(own) + 1, len(landmarks)))
    for j, m in enumerate(landmarks):
        matrix[place[list(m)], j] = list(m.values())

    def embed(text: str) -> np.ndarray:
        k = sum(weight * matrix[place[numbers]].sum(axis=0) for numbers, weight in _letter_numbers(codes(text)))
        return (k / size) @ root

    order = {w: -float(k) for k, w in enumerate(bad)}
    toxic = [s for r in rows if r["toxic"] == 1 for s in r["x"]]
    witness = [_best_window(s, order) for s in toxic if any(w in s.lower() for w in bad)]
    clean = [s[:WINDOW] for r in rows if r["toxic"] == 0 for s in r["x"][:2]]
    if not witness or not clean:
        return _constant(share)
    docs = [(" . ".join(r["x"]), r["toxic"]) for r in rows]
    good_x, bad_x = [embed(t) for t in clean], [embed(t) for t in witness]
    for again in range(3):
        x = np.array([*bad_x, *good_x])
        y = np.array([1.0] * len(witness) + [-1.0] * len(good_x))
        w = _svm(x, y)
        weights = (root @ w[:-1]) / size
        table = np.zeros(SYMBOLS**LETTERS, np.float32)
        for b, m in zip(weights, landmarks, strict=True):
            for k, v in m.items():
                table[k] += b * v
        if again == 2:
            break
        # the worst windows of clean documents are the next negatives
        for text, label in docs:
            if label == 0:
                c = codes(text)
                at = int(window_values(text, table).argmax())
                good_x.append(embed("".join(" " if s == OTHER else chr(96 + s) for s in c[at : at + WINDOW])))
    slopes, shift = _logistic(np.array([peaks(t, table, w[-1]) for t, _ in docs]), np.array([float(y) for _, y in docs]))
    return Model(table, float(w[-1]), slopes, shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of ``docs``, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.bias, model.slopes, model.shift))  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for b in batches:
            scores = [own.score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
