"""Rank fusion, pooling, reranking, selection, routing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import rate_code
from tessella.operators.relational import first_wins


@dataclass(frozen=True)
class Settings:
    """Retrieval parameters."""

    bm25_k: int = 50
    vec_k: int = 50
    rrf_k: int = 50
    rerank_k: int = 25
    threshold: float = 0.05
    final_k: int = 10
    fusion: str = "rrf"
    alpha: float = 0.5
    mode: str = "fixed"
    adaptive_threshold: float = 0.15
    pool_k: int | None = None


def candidates(lexical: DataFrame, vector: DataFrame) -> DataFrame:
    """(qid, doc_id, bm_rank?, vec_rank?, cand_pos): the lexical list first, then what only the vectors found."""
    both = lexical.select("qid", "doc_id", F.col("rank").alias("bm_rank")).join(vector.select("qid", "doc_id", F.col("rank").alias("vec_rank")), ["qid", "doc_id"], "full_outer")
    order = Window.partitionBy("qid").orderBy(F.col("bm_rank").asc_nulls_last(), F.col("vec_rank").asc_nulls_last(), "doc_id")
    return both.withColumn("cand_pos", F.row_number().over(order))


def reciprocal(k: int) -> Column:
    """The sum of 1 / (k + rank) over the lists that have the row."""
    return F.coalesce(1.0 / (k + F.col("bm_rank")), F.lit(0.0)) + F.coalesce(1.0 / (k + F.col("vec_rank")), F.lit(0.0))


def weighted(alpha: float, missing: int = 1000) -> Column:
    """Alpha / vector rank + (1 - alpha) / lexical rank, a missing rank being 1000."""
    return alpha / F.coalesce("vec_rank", F.lit(missing)) + (1 - alpha) / F.coalesce("bm_rank", F.lit(missing))


def fused(pairs: DataFrame, s: Settings) -> DataFrame:
    """Fused score and rank; ties keep candidate order."""
    score = reciprocal(s.rrf_k) if s.fusion == "rrf" else weighted(s.alpha)
    scored = pairs.withColumn("fused", F.round(score, 6))
    return scored.withColumn("fused_rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("fused"), "cand_pos")))


def pooled(ranked: DataFrame, s: Settings) -> DataFrame:
    """L04."""
    return ranked.where(F.col("fused_rank") <= min(s.pool_k or s.bm25_k + s.vec_k, s.rerank_k))


def reranked(pool: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The scorer adds rr_score; a null score counts as 0, so that a failed scorer keeps the fused order."""
    scored = scorer(pool).withColumn("rr_score", F.coalesce("rr_score", F.lit(0.0)))
    return scored.withColumn("rr_rank", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("rr_score"), "fused_rank")))


def selected(rows: DataFrame, s: Settings) -> DataFrame:
    """Fixed keeps scores above the threshold, adaptive those at or above its own; then the first final_k."""
    keep = F.col("rr_score") >= s.adaptive_threshold if s.mode == "adaptive" else F.col("rr_score") > s.threshold
    return rows.where(keep & (F.col("rr_rank") <= s.final_k))


def hybrid(lexical: DataFrame, vector: DataFrame, scorer: Callable[[DataFrame], DataFrame], s: Settings) -> DataFrame:
    """V08 over a batch of queries."""
    lists = (lexical.where(F.col("rank") <= s.bm25_k), vector.where(F.col("rank") <= s.vec_k))
    return selected(reranked(pooled(fused(candidates(*lists), s), s), scorer), s)


def exact_route(queries: DataFrame, docs: DataFrame, found: DataFrame, final_k: int, fill: int = 2) -> DataFrame:
    """Rows (qid, doc_id, route, rank). A query that names a code with hits gets those, in store order, filled up with
    at most `fill` hybrid rows if they are fewer than final_k; any other query keeps its hybrid rows (qid, doc_id, rank)."""
    coded = queries.select("qid", rate_code(F.col("text")).alias("code")).where("code <> ''")
    hits = coded.join(docs.select("doc_id", "code"), "code").select("qid", "doc_id", F.lit("exact").alias("route"), F.lit(0).alias("priority"), F.col("doc_id").alias("pos"))
    sized = hits.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    rest = found.select("qid", "doc_id", "rank").join(sized, "qid", "left").where(F.col("n").isNull() | ((F.col("n") < final_k) & (F.col("rank") <= fill)))
    rows = hits.unionByName(rest.select("qid", "doc_id", F.lit("hybrid").alias("route"), F.lit(1).alias("priority"), F.col("rank").cast("long").alias("pos")))
    unique = first_wins(rows, ["qid", "doc_id"], ["priority", "pos"])
    return unique.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("priority", "pos", "doc_id"))).where(F.col("rank") <= final_k).select("qid", "doc_id", "route", "rank")
