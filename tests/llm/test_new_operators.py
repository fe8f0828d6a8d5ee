"""Collocations, exact dedup and token alignment against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import alignment, collocations, common, exact
from eventide.llm.queries import QUERIES, tokenizer_path

SF0001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, h string, norm string, `row` int, a int, words string, variant int"
A_PATH, B_PATH = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def prose(seed: int, n: int, words: int = 30) -> str:
    rng = np.random.default_rng(seed)
    parts = rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n"], n)
    return "".join(f"W{w}{p}" for w, p in zip(rng.integers(0, words, n), parts))


ROWS = [
    (1, prose(1, 300), "en"),
    (2, prose(1, 300) + "  \n", "en"),
    (3, prose(1, 300).replace(" ", ""), "de"),
    (4, None, "en"),
    (5, "", None),
    (6, " \n\t ", None),
    (7, "one two three", "und"),
    (8, "Spam, " * 400, "de"),
    (9, prose(9, 6000), "en"),
    (9, prose(9, 6000), "en"),
    (None, prose(1, 300), "en"),
    (10, "café naïve 你好 ▁ mark <s> <|endoftext|> <0x41> \U0001f600\U0001f600", "fr"),
    (11, "a" * 30000, "en"),
    (12, "x y \x1c z\x85 w  　 end ", "fr"),
    (13, "▁▁ a", "fr"),
    (14, "<s></s> <unk> tail\x00nul", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, "x", "x", 1, 2, "x", 3) for i, t, lang in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_join_split_is_a_join(spark):
    rows = spark.range(10000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100)).alias("k"), "id")
    found = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    want = sorted(map(tuple, rows.join(found, "k").collect()))
    assert sorted(map(tuple, common.join_split(rows, found, ["k"], share=8).select("k", "id", "v").collect())) == want
    weighed = found.join(rows.groupBy("k").count(), "k")
    split = common.join_split(rows, weighed, ["k"], F.col("count"), 10000, 8).select("k", "id", "v")
    assert sorted(map(tuple, split.collect())) == want


# --- exact dedup


def plain_exact(rows):
    classes = defaultdict(list)
    for k, (i, t, *_) in enumerate(rows):
        classes[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, k))
    out = []
    for norm, members in classes.items():
        stays = rows[min(members)[3]][0]
        out += [(rows[k][0], stays, len(members), hashlib.sha256(norm.encode()).hexdigest()) for *_, k in members]
    return Counter(out), len(classes)


def exact_rows(df):
    rows = df.collect()
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) <= {1} and all(r.doc_id == r.keep_id for r in rows if r.kept)
    return Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), len(kept)


def test_exact_duplicates(docs):
    assert exact_rows(exact.mark_duplicates(docs)) == plain_exact(ROWS)


def test_exact_duplicates_tell_collisions_apart(docs):
    weak = exact.mark_duplicates(docs, hasher=lambda t: F.unhex(F.hex(F.length(t) % 2)))
    assert exact_rows(weak) == plain_exact(ROWS)
    one = exact.mark_duplicates(docs, hasher=lambda t: F.unhex(F.lit("00")))
    assert exact_rows(one) == plain_exact(ROWS)


def test_exact_duplicates_hot_text(spark):
    rows = [(k, "same text" + " " * (k % 7) if k % 3 == 0 else f"text {k}") for k in range(600)]
    got = exact_rows(exact.mark_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_exact(rows)


def test_exact_duplicates_string_ids(spark):
    rows = [("b", "x y"), ("a", "xy "), ("c", "x  y"), (None, "x  y")]
    got = exact.mark_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r.keep_id for r in got} == {"c"} and sum(r.kept for r in got) == 1


def test_one_of_each_keeps_whole_rows(docs):
    kept = exact.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == plain_exact(ROWS)[1]
    assert {r.doc_id for r in kept.collect()} == {2, 4, 6, 7, 8, 9, 10, 11, 12, 13, 14, 3} - {3, 4}


def test_exact_duplicates_of_nothing(none):
    assert exact.mark_duplicates(none).collect() == []
    assert exact.one_of_each(none).collect() == []


# --- collocations


def plain_collocations(rows, support=10, max_words=3, percent=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= support}
        dropped = {p[i : i + k] for p, a in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= percent * c[p[i : i + k]]}
        scored = []
        for p, a in cand.items():
            if p not in dropped:
                score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), " ".join(p), c[p[:k]], c[p[k:]]))
        out += [(lang, r + 1, s[3], -s[1], s[4], s[5], n[lang], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out)


MORE = [(100 + k, prose(k, 400, 25), ["en", "de", None][k % 3]) for k in range(12)]


@pytest.fixture(scope="module")
def more(spark, docs):
    return docs.unionByName(spark.createDataFrame([(i, t, lang, "x", "x", 1, 2, "x", 3) for i, t, lang in MORE], SCHEMA)).repartition(7)


def test_collocations(more):
    got = collocations.collocations(more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations(ROWS + MORE)
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want


def test_collocations_of_four_words_in_small_blocks(more, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 5000)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 700)
    monkeypatch.setattr(collocations, "RANGE_BYTES", 1 << 12)
    got = collocations.collocations(more, support=4, max_words=4, nested_percent=70, top=50)
    assert sorted(map(tuple, got.collect())) == plain_collocations(ROWS + MORE, 4, 4, 70, 50)


def test_bit_table_has_every_position(spark):
    rng = np.random.default_rng(1)
    positions = np.unique(np.append(rng.integers(0, collocations.FILTER_BITS, 500), [0, 1, 32768, 32769, collocations.FILTER_BITS - 1]))
    table = collocations.bit_table(spark.createDataFrame([(int(p),) for p in positions], "position long"))
    at = collocations.bit_address(positions)
    assert ((table[at >> 3] >> (at & 7)) & 1).all()
    assert int(np.unpackbits(table).sum()) in (len(positions), len(positions) - 1)


def test_collocations_multiply_past_64_bits(spark):
    counts = [("en", 1, "x", 5 * 10**12), ("en", 1, "y", 4 * 10**12), ("en", 2, "x y", 3 * 10**12)]
    got = collocations.scored(spark.createDataFrame(counts, "lang string, words int, phrase string, a long")).collect()
    assert [r.score for r in got] == [1000000 * 9 // 20]


def test_collocations_of_nothing(none):
    assert collocations.collocations(none).collect() == []


# --- token alignment


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(A_PATH)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    alphabet = alignment.byte_alphabet()
    out, counts, held = [], Counter(), []
    for i, t, *_ in rows:
        a = a_model.encode(" " + (t or ""), add_special_tokens=False).ids
        b = b_model.encode(t or "")
        ab = [bytes(alphabet[c] for c in a_model.id_to_token(x)) for x in a]
        pieces = [b_model.id_to_piece(x) for x in b]
        bb = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        data = b" " + (t or "").encode()
        if not t or b"".join(ab) != data or b"".join(bb) != data:
            a, b, ab, bb = [], [], [], []
        ea, eb = np.cumsum([len(x) for x in ab]), np.cumsum([len(x) for x in bb])
        groups, x, y, links = [], 0, 0, []
        for p in range(len(a)):
            for q in np.flatnonzero(eb == ea[p]) if len(eb) else []:
                links.append((a[p], b[q]))
                groups.append(",".join(map(str, a[x : p + 1])) + "|" + ",".join(map(str, b[y : q + 1])))
                x, y = p + 1, q + 1
        counts.update(links)
        held.append(links)
        out.append((i, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return Counter((*o[:4], len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls), o[4]) for o, ls in zip(out, held))


def query_on(name, spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    return QUERIES[name](spark, str(folder))


def test_alignment(spark, docs, tmp_path):
    got = query_on("op13_alignment", spark, docs, tmp_path)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == plain_alignment(ROWS)


def test_alignment_of_the_small_table(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HOT_PAIRS", 64)  # most pairs go by the shuffle
    got = QUERIES["op13_alignment"](spark, SF0001)
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, got.collect())) == plain_alignment(map(tuple, rows))


def test_alignment_of_nothing(spark, none, tmp_path):
    assert query_on("op13_alignment", spark, none, tmp_path).collect() == []


def test_rank_table_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    encode, _ = alignment.byte_level_encoder(A_PATH)
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    more = [" lead", "  two  spaces ", "tab\t x", "it's  we'll don't\n\n\n y", "\u3000 wide", "a\x1c b", "12345  678 ...", "trailing "]
    for t in [*more, *(t for _, t, *_ in ROWS if t)]:
        assert encode(t) == a.encode(t, add_special_tokens=False).ids


def test_groups_as_arrays(docs):
    got = alignment.align(docs, A_PATH, B_PATH).withColumn("g", alignment.group_ids(F.col("groups"))).collect()
    for r in got:
        assert len(r.g) == r.n_groups == sum(x.n for x in r.links)
        assert sum(len(g.a) for g in r.g) == r.n_a and sum(len(g.b) for g in r.g) == r.n_b
