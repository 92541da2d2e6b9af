"""Exact deduplication by 128-bit content hash, in DataFrame operations only.

Texts are equal when they are identical after all of [\\x20\\x09-\\x0D] is deleted. Defined results:
null texts count as empty, and empty texts are equal to each other; of equal texts the row with the most code
points in its original text stays, then the one with the smallest doc_id (a null doc_id comes last). Rows that
repeat both doc_id and text are one document given more than once: each of them says the same. An empty table
gives no rows. Only doc_id and text are read, so that other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import cut, with_group_values

BLANKS = (" ", "\t", "\n", "\x0b", "\f", "\r")


def without_blanks(text: Column) -> Column:
    """Byte-level deletions: no regular expression, and no copy where a blank doesn't occur."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def content_hash(norm: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(norm))


def collisions(normalised: DataFrame) -> DataFrame:
    """(hash, norm) of hashes that stand for more than one text.

    Bytes are compared by grouping on (hash, norm): each map task sends a text once, however many copies it has,
    so that a hot group needs no more than a row from each task.
    """
    texts = normalised.groupBy("hash", "norm").agg(F.lit(1).alias("one"))
    several = texts.groupBy("hash").agg(F.count("one").alias("texts")).where("texts > 1").select("hash")
    return several


def exact_duplicates(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    narrow = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    normalised = narrow.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), without_blanks(F.col("text")).alias("norm"))
    hashed = normalised.withColumn("hash", hash_of(F.col("norm")))
    # One number comes back: whether any hash stands for two texts. The rows that do are cut, and normally none.
    colliding = cut(collisions(hashed.select("hash", "norm")))
    facts = hashed.select("doc_id", "chars", "hash", F.sha2("norm", 256).alias("text_sha256"), F.lit(0).cast("long").alias("variant"))
    if not colliding.isEmpty():
        apart = hashed.join(colliding, "hash", "left_semi")
        texts = apart.select("hash", "norm").distinct()
        # Any number that differs between the texts of a hash will do; their order under it is that of the bytes.
        numbered = texts.withColumn("variant", F.row_number().over(_by_hash()).cast("long"))
        split = apart.join(numbered, ["hash", "norm"]).select("doc_id", "chars", "hash", F.sha2("norm", 256).alias("text_sha256"), "variant")
        facts = facts.join(colliding, "hash", "left_anti").select("doc_id", "chars", "hash", "text_sha256", "variant").unionByName(split)
    facts = cut(facts)  # no texts in it; three stages read it
    # The best row has the greatest (chars, not null, -doc_id).
    rank = F.struct(F.col("chars").alias("chars"), F.col("doc_id").isNotNull().cast("int").alias("known"), (-F.coalesce("doc_id", F.lit(0))).alias("minus"))
    grouped = with_group_values(
        facts,
        ["hash", "variant"],
        F.xxhash64("doc_id", "chars"),
        [F.count(F.lit(1)).alias("n"), F.max(rank).alias("best")],
        [F.sum("n").alias("group_size"), F.max("best").alias("best")],
    )
    keep = F.when(F.col("best.known") == 1, -F.col("best.minus"))
    return grouped.select(
        "doc_id",
        keep.alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("chars") == F.col("best.chars"))).alias("kept"),
        "text_sha256",
    )


def _by_hash():
    from pyspark.sql import Window

    return Window.partitionBy("hash").orderBy("norm")
