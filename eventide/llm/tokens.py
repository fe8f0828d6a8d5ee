"""Token counts with a finite-state tokenizer.

A byte-pair model's segmentation of a prefix is determined from the left: the
last token t of a prefix is the one token that ends there for which t and the
token before it stay two tokens when encoded together.  So a deterministic
transducer can read a text character by character.  Its state holds what the
future depends on: the longest suffix that can still grow into a piece, and
for every position in it the token that ends there and the number of tokens up
to there, relative to now.  Each transition is annotated with the change of
the token count.

States and transitions are compiled when first used, from the model's pieces
and the model's own encoding of token pairs, and kept in tables of bounded
size.

Texts are cut into chunks: words, and pieces of ``CHUNK`` characters of longer
words.  The map of a chunk takes an entry state to (exit state, tokens).  A
whole word's map is a constant, since nothing merges across a word boundary:
Arrow cuts and numbers the words of a batch, each distinct word is run once,
and the maps of all chunks of the batch compose in one prefix scan (for
constants a running sum), read off at the ends of the documents.  The map of a
piece of a long word is its run from the first state; another entry state only
has to be followed until both runs are in the same state.  Such maps compose
associatively, and are combined in a tree.  The scan is parallel over the
chunks of a batch within a task, and Spark's tasks run beside each other; one
text is never dealt over several tasks.

Defined results: null and empty texts have no tokens; special strings in a
text are ordinary text, as in the library; equal rows get equal counts, null
and repeated doc_ids stay; an empty table gives no rows; very long texts and
words take time in proportion to their length; only doc_id and text are read,
so further columns cannot clash."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import kept_by_process

BLANK = "▁"  # the model's word mark
CHUNK = 1 << 12
SHORT = 64  # characters of a word that is remembered
SLICE_BYTES = 8 << 20  # text cut into words at a time
MAX_STATES = 250_000  # then the tables are dropped and compiled anew
MAX_PAIRS = 600_000
MAX_PLANS = 300_000
MAX_WORDS = 400_000


class _State(dict):
    """Transitions {character: (state, tokens emitted)} of one state."""

    __slots__ = ("ends", "suffix")

    def __init__(self, suffix: str, ends: tuple):
        super().__init__()
        self.suffix = suffix  # longest suffix of the text that starts a piece
        # (token ending there, tokens up to there minus tokens up to now), for
        # the positions 0..len(suffix) characters back at which a piece can start
        self.ends = ends


class ChunkMap(NamedTuple):
    text: str
    tokens: int  # from the first state on
    exit: _State


class Transducer:
    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        m = self.model
        plain = [i for i in range(m.vocab_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.pieces = {m.id_to_piece(i) for i in plain}
        if any(BLANK in p.lstrip(BLANK) for p in self.pieces):
            raise ValueError("pieces that go on after a word boundary are not supported")
        self.starts = {p[:k] for p in self.pieces for k in range(len(p) + 1)}
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.plans: dict[str, tuple] = {}
        self.states: dict[tuple, _State] = {}
        self.origin = self._state("", ((None, 0),))
        self.words: dict[str, int] = {}

    def _state(self, suffix: str, ends: tuple) -> _State:
        key = (suffix, ends)
        if key not in self.states:
            self.states[key] = _State(suffix, ends)
        return self.states[key]

    def _stays(self, before: str | None, token: str) -> bool:
        """Whether the model keeps ``token`` after the token ``before``."""
        key = (before, token)
        if key not in self.pairs:
            # a line feed is no piece: it shields the pair from the mark that the library puts first
            found = self.model.encode("\n" + (before or "") + token, out_type=str)[2:]
            self.pairs[key] = found == ([token] if before is None else [before, token])
        return self.pairs[key]

    def _plan(self, text: str) -> tuple[list[tuple[int, str]], int, list[bool]]:
        """What ``text``, a state's suffix and the next character, leaves to
        decide: the tokens that may end it, longest first, the length of the
        suffix to keep, and from which of its positions a piece can come."""
        plan = self.plans.get(text)
        if plan is None:
            size = len(text)
            tails = [text[size - n :] for n in range(size + 1)]
            keep = next(n for n in range(size, -1, -1) if tails[n] in self.starts)
            plan = self.plans[text] = (
                [(n, tails[n]) for n in range(size, 0, -1) if tails[n] in self.pieces],
                keep,
                [tails[n] in self.starts for n in range(1, keep + 1)],
            )
        return plan

    def _compile(self, state: _State, c: str) -> tuple[_State, int]:
        """The transition of ``state`` on ``c``."""
        if c not in self.pieces:  # bytes; nothing merges across them
            step = (self.origin, len(c.encode()))
        else:
            suffix, ends = state.suffix, state.ends
            if c == BLANK and not suffix.endswith(BLANK):  # nor across a word boundary
                suffix, ends = "", ((None, 0),)
            text = suffix + c
            tokens, keep, open_at = self._plan(text)
            for n, token in tokens:
                before, count = ends[n - 1]
                if self._stays(before, token):
                    break
            else:
                raise ValueError(f"no token ends at {text!r}")
            emitted = count + 1
            after = [(token, 0)]  # a position from which no piece can come has no future
            after += [(e[0], e[1] - emitted) if going else None for e, going in zip(ends, open_at, strict=False)]
            step = (self._state(text[len(text) - keep :], tuple(after)), emitted)
        state[c] = step
        return step

    def run(self, state: _State, text: str) -> tuple[_State, int]:
        total = 0
        for c in text:
            step = state.get(c) or self._compile(state, c)
            state = step[0]
            total += step[1]
        return state, total

    def chunk_map(self, chunk: str) -> ChunkMap:
        state, tokens = self.run(self.origin, chunk)
        return ChunkMap(chunk, tokens, state)

    def apply(self, state: _State, chunk: ChunkMap) -> tuple[_State, int]:
        """Exit state and tokens of a chunk that is entered in ``state``."""
        mine, usual, more = state, self.origin, 0
        for c in chunk.text:
            if mine is usual:
                return chunk.exit, chunk.tokens + more
            a, b = mine.get(c) or self._compile(mine, c), usual.get(c) or self._compile(usual, c)
            mine, usual, more = a[0], b[0], more + a[1] - b[1]
        return mine, chunk.tokens + more

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        state, n = self.apply(a.exit, b)
        return ChunkMap(a.text + b.text, a.tokens + n, state)

    def _bounded(self) -> None:
        """Drop tables that have grown too large; not within a word."""
        if len(self.states) > MAX_STATES:
            self.states.clear()
            self.origin = self._state("", ((None, 0),))
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        if len(self.plans) > MAX_PLANS:
            self.plans.clear()
        if len(self.words) > MAX_WORDS:
            self.words.clear()

    def word(self, word: str) -> int:
        """Tokens of a whole word with its marks."""
        n = self.words.get(word)
        if n is None:
            self._bounded()
            maps = [self.chunk_map(word[i : i + CHUNK]) for i in range(0, len(word), CHUNK)]
            while len(maps) > 1:
                maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
            n = maps[0].tokens
            if len(word) <= SHORT:
                self.words[word] = n
        return n

    def _read(self, words: list[str]) -> None:
        """Tokens of whole words, remembered; in order, so that a word goes on
        from where it parts from the one before."""
        path, previous = [(self.origin, 0)], ""
        for w in sorted(words):
            if len(self.states) > MAX_STATES or len(self.pairs) > MAX_PAIRS or len(self.plans) > MAX_PLANS:
                self._bounded()
                path, previous = [(self.origin, 0)], ""
            same = 0
            for a, b in zip(previous, w, strict=False):
                if a != b:
                    break
                same += 1
            del path[same + 1 :]
            state, total = path[-1]
            for c in w[same:]:
                step = state.get(c) or self._compile(state, c)
                state = step[0]
                total += step[1]
                path.append((state, total))
            self.words[w] = total
            previous = w

    def counts(self, texts: pa.StringArray) -> np.ndarray:
        """Tokens of each text."""
        parts = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), BLANK, " "), " ")
        ends = parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()
        starts = np.append(0, ends[:-1])
        coded = parts.flatten().dictionary_encode()
        code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        # a mark stands before each part, the text's first one included; empty
        # parts leave theirs to the next word, or to the end of the text
        marked = [BLANK + w for w in distinct]
        if len(self.words) + len(marked) > MAX_WORDS:
            self.words.clear()
        self._read([w for w in marked if w not in self.words and 1 < len(w) <= SHORT])
        one = np.array([self.word(w) if len(w) > 1 else 0 for w in marked], np.int64)
        tokens = one[code]
        if "" in distinct:
            full = code != distinct.index("")
            at = np.arange(len(code))
            last = np.zeros(len(code), bool)
            last[ends - 1] = True
            before = np.maximum.accumulate(np.maximum(np.where(full, at, -1), np.repeat(starts - 1, ends - starts)))
            before = np.append(-1, before[:-1])  # the last full part, or the end of the text before
            before = np.maximum(before, np.repeat(starts - 1, ends - starts))
            marks = at - before
            odd = np.flatnonzero(np.where(full, marks > 1, last))
            kinds, which = np.unique(np.stack([marks[odd], code[odd]]), axis=1, return_inverse=True)
            own = [self.word(BLANK * m + distinct[c]) for m, c in kinds.T.tolist()]
            tokens[odd] = np.array(own, np.int64)[which.reshape(-1)] if own else 0
        scan = np.append(0, np.cumsum(tokens))
        return np.where(pc.binary_length(pc.fill_null(texts, "")).to_numpy() > 0, scan[ends] - scan[starts], 0)

    def count(self, text: str | None) -> int:
        return int(self.counts(pa.array([text], pa.string()))[0])


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = kept_by_process(("tokens", model), lambda: Transducer(model))
        for b in batches:
            size = pc.binary_length(pc.fill_null(b.column(1), "")).cast(pa.int64())
            part = np.cumsum(size.to_numpy()) // SLICE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
            counts = [transducer.counts(b.column(1).slice(i, j - i)) for i, j in zip(cuts, cuts[1:], strict=False) if i < j]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), size, pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], names=["doc_id", "n_bytes", "n_tokens"]
            )

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def over_limit(limit: int = 4096):
    return F.col("n_tokens") > limit
