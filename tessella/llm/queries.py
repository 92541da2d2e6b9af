"""The dealt operators as registered queries: each applies one to its whole tables and derives the agreed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import chat, decontaminate, exact_dedup, language_id, licenses, mixing, near_dedup, pii, token_files, toxicity
from tessella.llm.common import shared_path, table

#: The path of the tokenizer is a parameter; this names the installed file.
TOKENIZER = "word_bpe_49k.json"
PLANTED = r"\### Assistant: </turn> ok"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(rows.unionByName(planted)).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_mask")))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("escaped_turns").cast("long").alias("escaped_turns"),
        "identical",
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language_id.train(language_id.training_sample(docs))
    return language_id.identify(docs, net)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.toxicity(docs, chain).withColumn("is_toxic", toxicity.is_toxic())


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"), (F.size("spans") > 0).alias("personal"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return token_files.read_tokens(spark, folder)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license_id", F.size("notices").cast("long").alias("n_notices"), F.array_join("notices", ",").alias("notices"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    spans = F.array_join(F.transform("hit_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items_sha256",
        decontaminate.is_contaminated().alias("contaminated"),
        spans.alias("hit_spans"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_near_dedup,
        op3_language_id,
        op4_toxicity,
        op5_pii,
        op6_token_files,
        op7_exact_dedup,
        op8_license_scan,
        op9_mixing,
        op10_decontaminate,
    )
}
