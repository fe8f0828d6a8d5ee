"""The training-data operators against plain versions, on small tables with
nulls, empty and long texts, repeated rows and extra columns."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import decontam, packing, pii, quality, simhash, substrings, tokens, toolcalls, toxicity, warc
from eventide.llm.queries import QUERIES, tokenizer_path

WORDS = [f"w{i}" for i in range(40)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, `length` int"


def text(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


ROWS = [
    (1, text(1, 300)),
    (2, text(1, 300)),
    (3, text(1, 150) + " " + text(3, 150)),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one two three"),
    (8, "spam " * 400),
    (9, text(9, 5000)),
    (9, text(9, 5000)),
    (None, text(1, 300)),
    (10, "mail a.b@c.de or\n+1 (286) 555-5136, 10.0.0.256 and 10.0.0.255; 4111 1111 1111 1111 x@y z@z@q.com"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s", 0, "x", 1) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {*QUERIES, "pipeline"} <= set(names)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_quality_statistics(docs):
    got = docs.select("text", quality.statistics(F.col("text")).alias("s")).collect()
    for t, s in got:
        w = (t or "").encode().split()
        w = [x.decode() for x in w]
        three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {i + k for i, x in enumerate(three) if three.count(x) > 1 for k in range(3)} if len(w) < 1000 else None
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        assert s["n_words"] == len(w)
        assert s["word_chars"] == sum(map(len, w))
        assert s["n_dup_lines"] == len(lines) - len(set(lines))
        assert s["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
        if again is not None:
            assert s["n_repeat_words"] == len(again)


def test_quality_both_ways_to_find_repeats_agree(docs, monkeypatch):
    one = docs.select(quality.statistics(F.col("text"))["n_repeat_words"].alias("n")).collect()
    monkeypatch.setattr(quality, "FEW_KEYS", 0)
    assert docs.select(quality.statistics(F.col("text"))["n_repeat_words"].alias("n")).collect() == one


def test_quality_filter(docs, none):
    kept = quality.filter_quality(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} & {4, 5, 6, 7, 8} == set()
    assert quality.filter_quality(none).count() == 0


def test_simhash_against_all_pairs(docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    import xxhash

    def fingerprint(t):
        w = (t or "").lower().encode().split()
        if not w:
            return 0
        k = min(4, len(w))
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(len(w) - k + 1)]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [fingerprint(t) for _, t in ROWS]
    group = list(range(len(ROWS)))
    for i in range(len(ROWS)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min(ROWS[i][0] for i in range(len(ROWS)) if group[i] == g and ROWS[i][0] is not None) for g in set(group)}
    want = sorted((str(r[0]), prints[i], least[group[i]]) for i, r in enumerate(ROWS))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == want
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_search_loses_no_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 60)
    prints = []
    for b in base.tolist():
        for _ in range(15):
            x = b
            for bit in rng.choice(63, rng.integers(0, 6), replace=False).tolist():
                x ^= 1 << bit
            prints.append(x)
    frame = spark.createDataFrame(list(enumerate(prints)), "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.classes(frame, 4).collect()}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert got == {i: find(i) for i in range(len(prints))}


def test_one_of_each(docs):
    kept = simhash.one_of_each(docs.where("doc_id is not null"))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 4, 7}
    assert 2 not in {r.doc_id for r in kept.collect()}


def test_one_of_each_class_whatever_the_ids(spark):
    rows = [
        (None, text(20, 200)),
        (None, text(21, 200)),
        (None, text(21, 200)),
        (None, text(22, 200)),
        (1, text(23, 200)),
        (2, text(23, 200)),  # a copy of 1
        (2, text(24, 200)),  # and the head of another class
        (3, text(25, 200)),
        (None, text(25, 200)),
    ]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(None, text(20, 200)), (None, text(21, 200)), (None, text(22, 200)), (1, text(23, 200)), (2, text(24, 200)), (3, text(25, 200))]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("shard_rows", [20_000, 2])
def test_substrings_against_all_windows(docs, none, shard_rows, monkeypatch):
    monkeypatch.setattr(substrings.removals, "__defaults__", (shard_rows,))
    order = [(1 << 62 if i is None else i, (t or "").split()) for i, t in ROWS]
    first = {}
    for i, w in sorted(order, key=lambda x: x[0]):
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    want = []
    for (i, w), (raw, _) in zip(order, ROWS, strict=True):
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        want.append((str(raw), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substrings.deduplicate(docs).collect()]
    assert sorted(got) == sorted(want)
    assert substrings.deduplicate(none).count() == 0


def test_substrings_words_of_slices(monkeypatch):
    texts = ["a\u00a0b\x1cc\u0085  d\x0b\x0c\r\n\t", None, "", " ", "e", "f", " Šé \U0001d400\ng ", "h" * 50, "i j"]
    for size in (1, 10, 1 << 19):
        monkeypatch.setattr(substrings, "SLICE_BYTES", size)
        batch = pa.RecordBatch.from_arrays([pa.array(["x", *texts, "y"], pa.string())], names=["t"]).slice(1, len(texts))
        got = []
        for part, words in substrings._slices(batch, 0):
            line, begin, end = words.line()
            assert np.diff(words.first).sum() == len(words.doc) == len(begin)
            for k in range(part.num_rows):
                got.append([bytes(line[begin[i] : end[i]]) for i in range(words.first[k], words.first[k + 1])])
        assert got == [(t or "").encode().split() for t in texts]


def test_substrings_automaton_stays_small(monkeypatch):
    import ahocorasick

    lines = [f"{text(k, 300)} n{k}" for k in range(40)]
    rows = [(k, [5, 400], t) for t in lines for k in (1, 2, 3)]
    table = pa.table(
        {
            "salted": pa.array([False] * len(rows)),
            "doc_id": pa.array([k for k, _, _ in rows]),
            "uid": pa.array(range(len(rows))),
            "firsts": pa.array([f for _, f, _ in rows], pa.list_(pa.int32())),
            "words": pa.array([t for _, _, t in rows]),
        }
    )
    added = []

    class Automaton:
        def __init__(self, make=ahocorasick.Automaton):
            self.own = make()
            self.make_automaton, self.iter = self.own.make_automaton, self.own.iter

        def add_word(self, word, value):
            added.append(word)
            return self.own.add_word(word, value)

    monkeypatch.setattr(ahocorasick, "Automaton", Automaton)
    got = {(r["uid"], r["a"], r["b"]) for r in substrings._locate(table).to_pylist()}
    # of each line, every window of the two later rows, at both places
    assert got == {(u, x, x + len(t.split()) - 13) for u, (k, _, t) in enumerate(rows) if k > 1 for x in (5, 400)}
    # nodes have few children whatever the vocabulary, and chains are shorter than windows of single words
    assert len({w[0] for w in added}) <= 256 and max(map(len, added)) <= 2 * 6


def test_decontamination(spark, docs, none):
    whole = text(9, 5000).split()
    items = spark.createDataFrame(
        [("a", " ".join(whole[100:130]).upper()), ("b", "three"), ("c", None), ("d", "..."), (None, "two, three")], "item_id string, text string"
    )
    got = {r.doc_id: r[decontam.HITS] for r in decontam.scan(docs, items).collect()}
    assert got[9]["items"] == ["a"] and [tuple(x) for x in got[9]["words"]] == [(100, 130)]
    span = got[9]["spans"][0]
    assert text(9, 5000)[span["start"] : span["end"]] == " ".join(whole[100:130])
    assert got[7]["items"] == ["b"] and [tuple(x) for x in got[7]["words"]] == [(1, 3)]
    assert got[4]["n_words"] == 0 and not got[1]["words"]
    assert {r.doc_id for r in decontam.clean(docs, items).collect()} & {7, 9} == set()
    assert decontam.clean(docs, items.where("false")).count() == len(ROWS)
    assert decontam.clean(none, items).count() == 0


def test_decontamination_in_shards(docs, spark, monkeypatch):
    items = spark.createDataFrame([(str(k), text(k, 60)) for k in (1, 3, 9, 77)], "item_id string, text string")
    one = sorted(map(str, decontam.scan(docs, items).select("doc_id", decontam.HITS).collect()))
    monkeypatch.setattr(decontam, "SHARD_BYTES", 2000)
    assert sorted(map(str, decontam.scan(docs, items).select("doc_id", decontam.HITS).collect())) == one


def test_pii_base_spans(docs, none):
    got = {r.doc_id: r for r in pii.detect(docs).collect()}
    t = dict(ROWS)[10]
    found = [(pii.KINDS[s["kind"]], t[s["start"] : s["end"]]) for s in got[10]["base"]]
    assert found == [
        ("email", "a.b@c.de"), ("phone", "+1 (286) 555-5136"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("email", "z@q.com"),
    ]
    assert got[4]["spans"] == [] and pii.detect(none).count() == 0
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[10] == "mail [EMAIL] or\n[PHONE], 10.0.0.256 and [IP]; [CARD] x@y z@[EMAIL]"
    assert out[1] == dict(ROWS)[1] and out[4] is None


def test_pii_learns_a_context(spark):
    rows = [(i, f"please call back number: +1 28655{i:05d} after work today {i}") for i in range(40)]
    rows += [(100 + i, f"please call back number: 028655{i:05d} after work today") for i in range(3)]
    rows += [(200, "there were 0286550001 others of them here")]
    got = {r.doc_id: r.spans for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in (100, 101, 102):
        assert [pii.KINDS[s["kind"]] for s in got[k]] == ["phone"]
    assert got[200] == []


def test_token_counts_equal_the_library(docs, none):
    import sentencepiece

    model = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    extra = ["<s> </s> <unk> a  b▁c", "İ中\U0001d538 é\x00\x1f", "x" * 3000, " " * 100]
    got = tokens.token_counts(docs, model).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted((len((t or "").encode()), len(sp.encode(t or ""))) for _, t in ROWS)
    machine = tokens.Transducer(model)
    assert [machine.count(t) for t in extra] == [len(sp.encode(t)) for t in extra]
    assert tokens.token_counts(none, model).count() == 0


def test_chunk_maps_compose(monkeypatch):
    model = tokenizer_path("piece_bpe_32k.model")
    machine = tokens.Transducer(model)
    t = "the quick  brown foxes   jumped\nover unbelievable 中 things" * 3
    whole = machine.count(t)
    for size in (1, 3, 7, 50):
        monkeypatch.setattr(tokens, "CHUNK", size)
        assert machine.count(t) == whole


def test_packing_round_trip(docs, none):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, keep_ids=True).collect()
    ids = {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.piece)):
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) and r.start == 2048 * r.piece
        if r.doc_id not in (9,):
            ids[r.doc_id] = ids.get(r.doc_id, b"") + bytes(r.ids)
    for i, t in ROWS:
        if i != 9:
            assert np.frombuffer(ids[i], "<u4").tolist() == [*tk.encode(t or "", add_special_tokens=False).ids, 0]
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert packing.pack_documents(none, path).count() == 0


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 101, 400)
    where, _ = packing.best_fit_decreasing(lengths, 100)
    rooms = []
    plain = {}
    for k in np.argsort(-lengths, kind="stable").tolist():
        fits = [b for b, room in enumerate(rooms) if room >= lengths[k]]
        if fits:
            b = min(fits, key=lambda b: rooms[b])
            rooms[b] -= lengths[k]
        else:
            b = len(rooms)
            rooms.append(100 - lengths[k])
        plain[k] = b
    used = np.bincount(where, weights=lengths)
    assert len(used) == len(rooms) and sorted(used) == sorted(100 - r for r in rooms)


def test_toxicity(spark):
    def doc(k, bad):
        return (k, text(k, 60) + (" you idiot " if bad else " ") + text(1000 + k, 20), int(bad))

    rows = [doc(k, k % 4 == 0) for k in range(160)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(known, known)
    fresh = [doc(5000 + k, k % 2 == 0) for k in range(40)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(fresh, "doc_id long, text string, toxic int"), model).collect()}
    assert all((got[k] >= 0.3) == bool(y) for k, _, y in fresh)
    assert model.score("what an i.d.i.o.t you are") > model.score("what an apple you are")
    assert 0 <= model.score(None) < 0.3 and model.score("") == model.score(None)


def test_landmarks_of_rare_insults(spark):
    # four insults of a common language, 80 of rare ones
    bad = [(f"{w} {text(1000 + k, 30)} n{k}", 1) for k in range(600) for w in ["blockhead", "numskull", "dimwitted", "simpleton"][k % 4 : k % 4 + 1]]
    rare = [(f"{'bcdfghjklm'[k % 10]}{'aeiouwxy'[k // 10]}zurro {text(5000 + 10 * k + j, 30)} r{j}", 1) for k in range(80) for j in range(8)]
    clean = [(f"{text(9000 + k, 30)} c{k}", 0) for k in range(3000)]
    rows = [(i, t, y) for i, (t, y) in enumerate(bad + rare + clean)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs = toxicity._identity(known)
    found, _ = toxicity.landmark_words(docs, docs.drop("text").join(known.select("doc_id", "toxic"), "doc_id"))
    assert set(found) == {t.split()[0][: toxicity.STEM] for t, y in bad + rare}


def test_landmarks_shuffle_stems_as_lines(spark, monkeypatch):
    rows = [(k, f"blockhead {text(k, 30)}", 1) for k in range(20)] + [(100 + k, text(200 + k, 30), 0) for k in range(60)]
    rows += [(None, "blockhead", 1), (500, "", 0), (501, None, 0), (502, "Ärger, ärgerlich! a b", 0), (502, "Ärger, ärgerlich! a b", 0)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    kept = {}
    monkeypatch.setattr(toxicity, "staged", lambda df, name: kept.setdefault(name, df))
    docs = toxicity._identity(known)
    toxicity.landmark_words(docs, docs.drop("text").join(known.select("doc_id", "toxic"), "doc_id"))
    want = {}
    for t, y in {(t or "", y) for i, t, y in rows if i is not None}:
        for w in {w[: toxicity.STEM] for w in re.split(r"[\W_]+", t.lower()) if len(w) >= toxicity.LETTERS}:
            want.setdefault(w, [0, 0])[1 - y] += 1
    assert {r.w: [r.bad, r.good] for r in kept["toxicity-words"].collect()} == want

    def joined(plan):  # types of the columns that go into joins
        below = [plan.children().apply(k) for k in range(plan.children().size())]
        own = [c.output().apply(k).dataType().typeName() for c in below for k in range(c.output().size())] if plan.nodeName() == "Join" else []
        return own + [t for c in below for t in joined(c)]

    types = joined(kept["toxicity-words"]._jdf.queryExecution().optimizedPlan())
    assert "string" in types and "array" not in types


def test_toxicity_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int")
    assert toxicity.fit(empty, empty).score("anything") < 0.01


def test_symbols_of_all_alphabets():
    assert toxicity.codes("Šé Éš").tolist() == toxicity.codes("se es").tolist()
    assert len(set(toxicity.codes("слово λέξη").tolist()) - {toxicity.OTHER}) > 4
    assert toxicity.codes("\U0001d400\ud800").size == toxicity.codes("a").size
    assert toxicity.codes(None).tolist() == toxicity.codes("").tolist() == [toxicity.OTHER]


def test_kernel_counts_subsequences():
    f = toxicity.features("abcd")
    assert list(f.values()) == [1.0]
    gap = toxicity.features("abxcd")
    shared = toxicity.kernel(f, gap)
    assert shared == pytest.approx(toxicity.DECAY)


def test_warc(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.b/c", '<html><head><title>T &amp; U</title></head><body><p>One<br>two</p><script>x="</p>"</script><a href="/l">L</a></body></html>'),
            (2, None, None),
            (None, "u", "plain &lt;b&gt; text"),
        ],
        "page_id long, url string, html string",
    )
    source = warc.responses(pages)
    rows = warc.derive(source).collect()
    assert len(rows) == 6 and len({r.record_id for r in rows}) == 6
    by = {(r.page_id, r.warc_type): r for r in rows}
    assert by[1, "conversion"].block == "One\ntwo\nL"
    assert by[None, "conversion"].block == "plain <b> text"
    meta = by[1, "metadata"]
    assert "title: T & U\r\n" in meta.block and "outlink: /l\r\n" in meta.block and "source-header: Content-Type: text/html" in meta.block
    given = {r.page_id: r for r in source.collect()}
    import hashlib

    for r in rows:
        assert r.refers_to == given[r.page_id].record_id and r.source_payload_digest == given[r.page_id].payload_digest
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode())
        assert f"WARC-Refers-To: {r.refers_to}\r\n" in r.header
    assert warc.derive(source.where("false")).count() == 0


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", "search", '{"query": "q", "limit": 3}', None, 1),
            (1, "b", "search", '{"limit": "3", "more": 1}', "a", 2),
            (1, "c", "lookup", "no json", "b", 3),
            (1, "d", "nothing", "{}", "gone", 4),
            (1, "e", "calculator", '{"expression": "1"}', "f", 5),
            (1, "f", "calculator", '{"expression": "1"}', "e", 6),
            (1, "a", "lookup", '{"key": "later copy"}', None, 9),
            (None, "a", "lookup", '{"key": "k"}', None, 1),
        ],
        "conv_id long, call_id string, name string, arguments string, after string, seq long",
    )
    results = spark.createDataFrame([(1, "a", 'say "x"', 2), (1, "z", "lost", 3), (None, "a", "n", 2)], "conv_id long, call_id string, content string, seq long")
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link(calls, results).collect()}
    assert len(got) == 8
    a = got[1, "a"]
    assert (a.status, a.level, a.call_copies, a.valid) == ("linked", 0, 2, True)
    assert a.canonical == '{"arguments":{"limit":3,"query":"q"},"call_id":"a","content":"say \\"x\\"","conv_id":1,"level":0,"name":"search","status":"linked"}'
    assert got[1, "b"].errors == "limit: not bigint; query: missing; more: unknown" and got[1, "b"].level == 1
    assert got[1, "c"].errors == "arguments: not a JSON object" and got[1, "c"].level == 2
    assert got[1, "d"].errors == "no tool nothing" and got[1, "d"].level == 0
    assert got[1, "e"].errors == got[1, "f"].errors == "order: cycle"
    assert got[1, "z"].status == "orphan" and got[None, "a"].status == "linked"
    assert toolcalls.link(calls.where("false"), results.where("false")).count() == 0


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    odd = [
        *(f"a{chr(c)}b {chr(c)}X{chr(c)}" for c in range(0x250)), "a<|endoftext|>b x", "A\u00a0b\u2003c\u3000", "x\x1cy \x1f", "don't I'LL 12345 $$$",
        "e\u0301 \u03a3\u0391\u03a3 \u039f\u0394\u039f\u03a3.", "\x00\x01ab", "", None, "  lead\ttrail \n", "a" * 200 + " " + "b" * 70, text(1, 6000),
    ]
    encode, plain = packing.WordEncoder(path, 0), Tokenizer.from_file(path)
    assert encode.parts is not None
    for _ in range(2):  # the second time words are known
        ids, bounds = encode(pa.array(odd, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [[*plain.encode(t or "", add_special_tokens=False).ids, 0] for t in odd]
    assert encode(pa.array([], pa.string()))[0].size == 0


def test_word_ids_take_bounded_memory(monkeypatch):
    import tracemalloc

    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "MEMO_PARTS", 1000, raising=False)
    encode = packing.WordEncoder(path, 0)
    encode(pa.array(["warm up"]))
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    for k in range(0, 100_000, 20_000):
        encode(pa.array([" ".join(f"q{n:x}z" for n in range(k, k + 20_000))]))
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 100 * 100_000  # bytes for 100,000 words
    monkeypatch.setattr(packing, "MEMO_WORDS", 40)
    monkeypatch.setattr(packing, "MEMO_PARTS", 5, raising=False)
    monkeypatch.setattr(packing, "ENCODE_WORDS", 3, raising=False)
    encode, plain = packing.WordEncoder(path, 0), Tokenizer.from_file(path)
    for k in range(0, 120, 10):  # much is forgotten and learnt again
        texts = [f"Don't {n % 50}abc \u4e2d{n % 7}\u6587 {'y' * 70} x{n}y  \n12345" for n in range(k, k + 10)] + [None, ""]
        for kind in (pa.string(), pa.large_string()):
            ids, bounds = encode(pa.array(texts, kind))
            got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            assert got == [[*plain.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
