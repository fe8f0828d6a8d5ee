"""The registered queries of the operators: each applies its operator to its
whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import alignment, collocations, decontam, exact, packing, pii, quality, simhash, substrings, tokens, toolcalls, toxicity, warc
from eventide.llm.common import staged, table

DISTANCE = 4
SHINGLE = 4
FOLDS = 4
TEST_FOLD = 2
CUT = 0.3


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.link(*toolcalls.events(table(spark, sf_dir, "conversations")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # the statistics are small: computed once, read by the fit and the verdict
    stats = staged(docs.select("doc_id", quality.statistics(F.col("text")).alias("s")), "quality-statistics")
    model = quality.fit_statistics(stats)
    judged = stats.select("doc_id", quality.judged_statistics(F.col("s"), model).alias("j"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col(f"j.s.{c}").alias(c) for c in base], "j.base_failed", "j.kept", F.round("j.posterior", 6).alias("posterior"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, DISTANCE)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.scan(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    h = F.col(decontam.HITS)
    return found.select(
        "doc_id",
        h["n_words"].alias("n_words"),
        decontam.n_hit().alias("n_hit"),
        F.size(h["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(h["items"], ","), 256).alias("items_sha256"),
        (F.size(h["words"]) > 0).alias("contaminated"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", tokens.over_limit())


def _fold():
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_fold() != TEST_FOLD)
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", F.coalesce(_fold() == TEST_FOLD, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))

    def count(k: int):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.span_string(F.col("base")), 256).alias("base_sha256"),
        pii.span_string(F.col("spans")).alias("spans"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_duplicates(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))

    rows = aligned.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        "n_a",
        "n_b",
        "n_groups",
        F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
        "links",
    )
    rows = staged(rows, "alignment")  # row numbers hold from here
    strength = alignment.link_strength(rows.select("row", "links"))
    sums = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return rows.drop("links").join(strength, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", *sums, "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc_derivatives,
        op2_best_fit_packing,
        op3_tool_calls,
        op4_quality_rules,
        op5_simhash,
        op6_decontamination,
        op7_token_counts,
        op8_toxicity,
        op9_substring_dedup,
        op10_pii,
        op11_collocations,
        op12_exact_dedup,
        op13_alignment,
    )
}
