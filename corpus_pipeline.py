"""A training corpus from documents: language ID, near-dedup, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again as the next one's docs. All but
the last return the columns of documents, whatever names further columns have.

Decisions to drop a row are made on the row where it is, or on a written row key, never on doc_id, which may be null or repeated.
Every stage takes empty tables, null texts and ids, repeated rows and very long texts; what it does with them is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontaminate, language_id, mixing, near_dedup, token_files
from tessella.llm.common import bounded_broadcast, cut, free_name, remove, shared_path, shared_uri, table
from tessella.llm.queries import tokenizer_path

#: The least mean probability of a document's language.
LEAST_SCORE = 0.35
#: The share of an identified document's words, in per cent, that may lie in benchmark items too short for a whole window.
SHORT_PERCENT = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is identified with at least LEAST_SCORE; null texts and texts without letters go.
    Equal texts are treated alike. Without two languages to learn from, every document with a letter is kept, or none if there is none."""
    net = language_id.train(language_id.training_sample(docs))
    return language_id.keep_identified(docs, net, LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group (five words, similarity 0.8): that of the smallest doc_id, null last.
    Rows that repeat id and text are a group; of rows that tie on the smallest id one stays. Texts without words (null,
    empty) are in no group and stay."""
    key = free_name(docs, "_row")
    path = shared_uri(spark, "rows")
    # The keys are written, so that every reader sees the same.
    docs.withColumn(key, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    thin = rows.select(F.col(key).alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    found = near_dedup.near_duplicates(thin.select(F.col("row").alias("doc_id"), "text"), width=5, percent=80).where("NOT kept")
    others = cut(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")))
    # A component is named by its first row, which the rows to drop leave out.
    members = others.unionByName(others.select(F.col("component").alias("row"), "component").distinct())
    members = cut(bounded_broadcast(cut(members), 32).join(thin.select("row", "doc_id"), "row"))
    stay = members.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least")).select("least.row")
    dropped = bounded_broadcast(cut(members.join(stay, "row", "left_anti").select(F.col("row").alias(key))), 24)
    return rows.join(dropped, key, "left_anti").drop(key)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no window of 13 consecutive words of a benchmark item, and of whose words less than SHORT_PERCENT lie
    in shorter items. Null texts hold none and stay; rows are decided on one by one."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), percent=SHORT_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes: a row for each pass a document has words in, so that a document may come up to three times, or
    not at all. Documents without words are never taken; a null source is a source of its own; rows that share id,
    source and text are taken as documents of their own."""
    return mixing.Mix(docs).rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row for each of its rows, read back from them: doc_id, start, n_tokens, ids_crc32. A null
    text has the end id only; rows without doc_id come first."""
    folder = shared_path(spark, "corpus")
    token_files.write_tokens(docs, folder, tokenizer_path())
    return token_files.read_tokens(spark, folder)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mix", mix), ("tokens", tokens)]

#: SQL can't express the language, near-duplicate, mixing and token stages; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage wrote is deleted once the next one's rows are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_uri(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    out = STAGES[-1][1](spark, docs, sf_dir)  # its files are written by now, and its rows are read from them
    remove(spark, before)
    return out
