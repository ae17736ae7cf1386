"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame``, whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from sentinela.llm import (
    byte_bpe, chat_format, collocations, decontamination, jaccard_join, language_id, lexical_search, packing, quality_ledger,
    simhash, suffix_dedup, toxicity, url_filter,
)
from sentinela.llm.base import materialise, read_table

#: The four rules every URL is judged by, then the method's own glob rules.
CONTRACT_RULES = [
    url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"),
]
#: Spam hosts by name, wherever the word stands in the host; they fill in where no contract rule fits.
SPAM_WORDS = ["pills", "casino", "viagra", "porn", "payday", "jackpot"]
SPAM_RULES = [url_filter.Rule("block", f"*{word}*", "") for word in SPAM_WORDS]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialise(simhash.edits(read_table(spark, sf_dir, "documents")), "simhash")
    near = lambda c: simhash.likeness(F.col("fingerprint"), F.col(c))
    return simhash.neighbours(found).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("edited_fingerprint").alias("near_edited"), near("next_fingerprint").alias("near_next"),
        "class_id", "near_docs")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_ledger.ledger(read_table(spark, sf_dir, "documents"))
    base = quality_ledger.policy(1)
    return (quality_ledger.apply_policy(book)
            .withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(base)) != 0)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", F.col("failed").alias("failed_bits")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(pages, CONTRACT_RULES, fallback=SPAM_RULES)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"), length=400, with_text=True)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
                        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "kept_sha256", "text")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    out = chat_format.format_chats(chats.unionByName(probe))
    turns = chat_format.read_turns(F.col("formatted"))
    loss = chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return (out.withColumns({"turns": turns, "loss": loss})
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), n=3, percent=90)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    samples = language_id.sample(docs.filter(language_id.learnable()))
    return (language_id.identified(docs.select("doc_id", "text"), samples)
            .select("doc_id", (~language_id.learnable()).alias("held_out"), "lang_pred", "score"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(read_table(spark, sf_dir, "documents"), path)
    return (byte_bpe.decode(ids, path)
            .select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (~toxicity.learnable()).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(read_table(spark, sf_dir, "documents"), path)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"), least=30, cover=80, top=2000) \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_filter": op3_url_filter,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_chat_format": op5_chat_format,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_language_id": op7_language_id,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_lexical_search": op12_lexical_search,
    "op13_decontamination": op13_decontamination,
}
