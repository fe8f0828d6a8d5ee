"""Brute-force checks of registered queries, and edge cases of the operators:
very long words and texts, clashing names, other types of ids."""

import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import decontam, pii, tokens, toolcalls
from eventide.llm.queries import QUERIES, tokenizer_path
from tests.conftest import SF001

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the plain expressions."""
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_of_whole_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    given = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.detect(docs).collect():
        want = plain_spans(given[r.doc_id])
        assert [(s["start"], s["kind"], s["end"]) for s in r.base] == want
        assert set(want) <= {(s["start"], s["kind"], s["end"]) for s in r.spans}


def test_candidates_and_their_contexts(spark):
    text = "Tel 0286550001 Fax 028 655 00002, Mob (0286) 550003 ends\nx@y here 12 of"
    found = spark.createDataFrame([(text,)], "text string").select(pii._candidates(F.col("text")).alias("c")).first().c
    assert [(c.value, c.before, c.after) for c in found] == [
        ("0286550001", "tel", "fax 000"),
        ("028 655 00002,", "0000000000 fax", "mob (0000)"),
        ("(0286) 550003", "00000, mob", "ends\nx@y"),
        ("x@y", "000000 ends", "here 00"),
        ("12", "x@y here", "of"),
    ]
    assert all(text[c.start : c.end] == c.value for c in found)


def test_bootstrap_goes_on_until_nothing_is_new(spark):
    def number(i):
        return f"0286 55 {i:05d}"

    rows, found = [], {}
    for k in range(6):  # the patterns of k are confident once the new number of k - 1 is known
        seeds = [f"+1 28655{10 * k + i:05d}" for i in range(4 if k == 0 else 3)]
        for value in [*seeds, *([number(k - 1)] if k else []), number(k)]:
            found[len(rows)] = value
            rows.append((len(rows), f"so word{'abcdef'[k]} said{'abcdef'[k]} {value} then{'abcdef'[k]} went{'abcdef'[k]} end"))
    rows.append((1000, f"there were {number(88)} others of them"))
    rows.append((1001, None))
    got = {r.doc_id: r.spans for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    for i, value in found.items():
        assert [(text[i][s["start"] : s["end"]], s["kind"]) for s in got[i]] == [(value, 3)]
    assert got[1000] == [] and got[1001] == []


def test_very_long_texts_of_personal_data(spark):
    many = " ".join(f"a{i}@b.cd" for i in range(20_000))
    rows = [(1, "x" * 1_000_000 + " 4111111111111111"), (2, "1 " * 500_000), (3, many), (4, "1a " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    began = time.time()
    got = {r.doc_id: r.spans for r in pii.detect(docs).collect()}
    assert [len(got[k]) for k in (1, 2, 3, 4)] == [1, 0, 20_000, 0]
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[1] == "x" * 1_000_000 + " [CARD]" and out[3] == " ".join(["[EMAIL]"] * 20_000)
    assert time.time() - began < 180


def test_redaction_of_overlapping_spans(spark):
    spans = [(2, 0, 5), (3, 1, 9), (9, 2, 10), (12, 3, 40), (13, 0, 14), (41, 1, 42)] + [(50 + 3 * k, k % 4, 52 + 3 * k) for k in range(300)]
    text = "".join(chr(0x61 + k % 26) for k in range(1000))
    want, at = "", 0
    for a, k, b in spans:
        if a >= at:
            want += text[at:a] + f"[{pii.KINDS[k].upper()}]"
        at = max(at, b)
    want += text[at:]
    rows = spark.createDataFrame([(text, [(*s, "") for s in spans])], "text string, spans array<struct<start:int,kind:int,end:int,value:string>>")
    assert rows.select(pii._redacted(F.col("text"), F.col("spans")).alias("t")).first().t == want


def test_clashing_names(spark):
    rows = [(1, "mail a@b.cd now", "own", "too", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __pii_key string, k_ string, __decontam_hits int")
    assert [tuple(r) for r in pii.redact(docs).collect()] == [(1, "mail [EMAIL] now", "own", "too", 5)]
    items = spark.createDataFrame([("i", "mail c now")], "item_id string, text string")
    assert [tuple(r) for r in decontam.clean(docs, items).collect()] == rows
    hit = spark.createDataFrame([("i", "mail a b cd")], "item_id string, text string")
    assert decontam.clean(docs, hit).count() == 0


@pytest.mark.parametrize("kind", ["string", "long"])
def test_tool_calls_of_any_conversation_id(spark, kind):
    a, b = ("conv-a", "conv-b") if kind == "string" else (1, 2)
    calls = [
        (a, "c1", "calculator", '{"expression": "1"}', None, 0), (a, "c2", "calculator", '{"expression": "2"}', "c1", 1),
        (a, "c3", "calculator", '{"expression": "3"}', "c2", 2), (b, "c1", "calculator", "{}", "c1", 0), (None, "c1", "nothing", None, "gone", 0),
    ]
    results = [(a, "c1", "one", 1), (b, "c9", "nine", 1), (None, "c1", "null", 2)]
    calls = spark.createDataFrame(calls, f"conv_id {kind}, call_id string, name string, arguments string, after string, seq int")
    results = spark.createDataFrame(results, f"conv_id {kind}, call_id string, content string, seq int")
    got = {(r.conv_id, r.call_id): (r.status, r.level) for r in toolcalls.link(calls, results).collect()}
    assert got == {
        (a, "c1"): ("linked", 0), (a, "c2"): ("unanswered", 1), (a, "c3"): ("unanswered", 2), (b, "c1"): ("unanswered", -1),
        (b, "c9"): ("orphan", None), (None, "c1"): ("linked", 0),
    }


def test_tool_call_levels_of_a_long_chain(spark):
    n = 1000
    rows = spark.range(n).selectExpr("'c' conv_id", "concat('i', id) call_id", "'t' name", "'{}' arguments", "if(id = 0, null, concat('i', id - 1)) after", "id seq")
    assert all(int(r.call_id[1:]) == r.level for r in toolcalls.levels(rows).collect())


def test_token_counts_of_whole_documents(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op7_token_counts"](spark, SF001).collect()
    assert len(got) == len(given)
    assert all((r.n_bytes, r.n_tokens) == (len(given[r.doc_id].encode()), len(model.encode(given[r.doc_id]))) for r in got)


def test_token_counts_of_odd_texts(monkeypatch):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model, machine = sentencepiece.SentencePieceProcessor(model_file=path), tokens.Transducer(path)
    rng = np.random.default_rng(1)
    odd = ["".join(rng.choice(list("ab the▁ \n中é  ing<s>1."), n)) for n in rng.integers(0, 60, 500)]
    odd += ["", " ", "  ", "a ", " a", "▁", "▁ ", None, " \n ", "x" * 100_000, "a " * 100_000, " " * 100_000, "unbelievable" * 9_000]
    want = [len(model.encode(t or "")) for t in odd]
    for chunk, states in ((1, 250_000), (7, 250_000), (4096, 50)):
        monkeypatch.setattr(tokens, "CHUNK", chunk)
        monkeypatch.setattr(tokens, "MAX_STATES", states)
        machine.words.clear()
        few = [k for k, t in enumerate(odd) if chunk > 100 or len(t or "") < 100]
        assert machine.counts(pa.array([odd[k] for k in few], pa.string())).tolist() == [want[k] for k in few]
