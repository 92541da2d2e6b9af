"""Questions to answers, and their evaluation, over batches of questions.

Models are injected: an embedder maps text to a vector column, a scorer adds rr_score to (question, document) rows, a generator maps a prompt
to text, a judge maps (sentence, context) to the probability that the sentence is unsupported.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions import text as X
from tessella.operators import context as C
from tessella.operators import fusion
from tessella.operators.relational import matching
from tessella.operators.vectors import cosine

#: Kinds of rerankers by what their names hold, in this order; anything else is a cross encoder.
KINDS = (("jina", "jina"), ("qwen", "causal_lm"), ("nemotron", "sequence"))


def reranker_kind(model: str, asked: str = "auto") -> str:
    """The kind that was asked for, else by the model's name."""
    if asked != "auto":
        return asked
    return next((kind for part, kind in KINDS if part in model.lower()), "cross_encoder")


def probability(kind: str, value: Column) -> Column:
    """What a kind's raw output becomes: the share of `yes` for causal models (struct yes, no), else the value itself."""
    return F.exp(value["yes"]) / (F.exp(value["yes"]) + F.exp(value["no"])) if kind == "causal_lm" else value


def judged(rows: DataFrame, judge: Callable[[Column, Column], Column], most: int = 4000) -> DataFrame:
    """(qid, faithfulness) from (qid, answer, contexts): the mean over the answer's sentences of being supported by the first
    `most` characters of the contexts. A null probability is a failure and counts as 1; an answer without sentences, or without contexts, has 0."""
    text = F.substring(F.array_join("contexts", " "), 1, most)
    sentences = F.when((F.size("contexts") > 0) & (X.strip(F.col("answer")) != ""), X.scoring_sentences(F.col("answer"))).otherwise(F.array().cast("array<string>"))
    each = rows.select("qid", text.alias("_text"), F.explode_outer(sentences).alias("_s"))
    scored = each.select("qid", F.when(F.col("_s").isNotNull(), F.coalesce(judge(F.col("_s"), F.col("_text")), F.lit(1.0))).alias("p"))
    means = scored.groupBy("qid").agg(F.coalesce(1 - F.avg("p"), F.lit(0.0)).alias("mean"))
    return means.select("qid", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("mean"))).alias("faithfulness"))


def referenced(questions: DataFrame, references: DataFrame, default: str = "нет данных") -> DataFrame:
    """Questions (qid, question) with their reference answers (question, reference), or the default."""
    known = references.select("question", "reference").dropDuplicates(["question"])
    return questions.join(known, "question", "left").withColumn("reference", F.coalesce("reference", F.lit(default)))


def ask(questions: DataFrame, lexical: DataFrame, vector: DataFrame, chunks: DataFrame, scorer: Callable[[DataFrame], DataFrame], s: fusion.Settings, generate: Callable[[Column], Column] = C.extractive, limit: int = 12_000, per_doc_cap: int = 5_000) -> DataFrame:
    """One row for each question (qid, question): answer, sources, docs_count, contexts and meta.

    chunks holds doc_id, text and the metadata work_code, title, source, clause, page. Questions with a known code take the exact route (V09).
    Found documents, final_k a question, are persisted; texts of no others move."""
    found = fusion.hybrid(lexical, vector, scorer, s).select("qid", "doc_id", F.col("rr_rank").alias("rank"), "rr_score").persist()
    routed = fusion.exact_route(questions.select("qid", F.col("question").alias("text")), chunks.select("doc_id", F.col("work_code").alias("code")), found, s.final_k).persist()
    rows = routed.join(matching(chunks, routed, "doc_id"), "doc_id").join(found.select("qid", "doc_id", "rr_score"), ["qid", "doc_id"], "left")
    built = C.docs_to_context(rows, limit, per_doc_cap).select("qid", "context")
    sources = C.collected(rows)
    order = F.sort_array(F.collect_list(F.struct("rank", "text", "rr_score", "route")))
    taken = rows.groupBy("qid").agg(order.alias("r"))
    lists = lexical.where(F.col("rank") <= s.bm25_k).groupBy("qid").agg(F.count(F.lit(1)).alias("bm25"))
    near = vector.where(F.col("rank") <= s.vec_k).groupBy("qid").agg(F.count(F.lit(1)).alias("vec"))
    every = questions.select("qid", "question").join(taken, "qid", "left").join(built, "qid", "left").join(sources, "qid", "left").join(lists, "qid", "left").join(near, "qid", "left")
    none = F.array().cast("array<struct<work_code:string,title:string,source_file:string,anchor:string>>")
    full = every.withColumns({"context": F.coalesce("context", F.lit("")), "sources": F.coalesce("sources", none)})
    said = C.answered(full, generate)
    exact = F.coalesce(F.exists("r", lambda x: x["route"] == "exact"), F.lit(False))
    top = F.transform(F.slice(F.filter("r", lambda x: x["rr_score"].isNotNull()), 1, 8), lambda x: F.round(x["rr_score"], 4))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    meta = F.struct(
        F.when(exact, F.lit("exact_code_match")).otherwise(F.lit("hybrid")).alias("mode"),
        F.lit(s.fusion).alias("fusion"),
        F.lit(s.mode).alias("retrieval_mode"),
        zero("bm25").alias("bm25"),
        zero("vec").alias("vec"),
        F.lit(s.pool_k or s.bm25_k + s.vec_k).alias("pool_k"),
        F.when(~exact, F.coalesce(top, F.array().cast("array<double>"))).alias("top_scores"),
    )
    contexts = F.coalesce(F.transform("r", lambda x: x["text"]), F.array().cast("array<string>"))
    return said.select("qid", "question", "answer", "sources", F.size(contexts).alias("docs_count"), contexts.alias("contexts"), meta.alias("meta"))


def triad(results: DataFrame, embed: Callable[[Column], Column], judge: Callable[[Column, Column], Column] | None = None, missing: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """(qid, context_relevance, faithfulness, answer_relevance) from (qid, question, answer, contexts, reference): the mean cosine of
    the question with the contexts; the judge's figure, or the mean cosine of the answer with the first three contexts; the cosine
    of answer and reference. `missing` is what stands where there is nothing to compare: zeros in a report, (0, 0.5, 0.5) in a search."""
    answered, known = X.strip(F.col("answer")) != "", X.strip(F.col("reference")) != ""
    flat = results.select("qid", "question", "answer", "reference", F.size("contexts").alias("n"), F.posexplode_outer("contexts").alias("at", "text"))
    embedded = flat.select("qid", "at", "n", answered.alias("answered"), (answered & known).alias("both"), *[embed(F.col(c)).alias(f"v{k}") for k, c in enumerate(("question", "answer", "reference", "text"))])
    there = F.col("at").isNotNull()
    sims = embedded.select("qid", "at", "n", "answered", F.when(there, cosine(F.col("v0"), F.col("v3"))).alias("cr"), F.when(there & F.col("answered") & (F.col("at") < 3), cosine(F.col("v1"), F.col("v3"))).alias("fa"), F.when(F.col("both"), cosine(F.col("v1"), F.col("v2"))).alias("ar"))
    rows = sims.groupBy("qid").agg(F.avg("cr").alias("cr"), F.avg("fa").alias("fa"), F.first("ar").alias("ar"), F.first("n").alias("n"))
    faith = F.col("fa")
    if judge:
        rows = rows.join(judged(results, judge).withColumnRenamed("faithfulness", "judged"), "qid", "left")
        faith = F.when(F.col("n") > 0, F.col("judged"))
    fill = lambda c, k: F.coalesce(c, F.lit(missing[k]))
    return rows.select("qid", fill(F.col("cr"), 0).alias("context_relevance"), fill(faith, 1).alias("faithfulness"), fill(F.col("ar"), 2).alias("answer_relevance"))


@dataclass(frozen=True)
class Trial:
    """The parameters of a trial, as a row beside the candidates instead of a change to a retriever."""

    trial: int
    bm25_k: int
    vec_k: int
    rrf_k: int
    rerank_k: int
    threshold: float
    final_k: int
    fusion: str = "rrf"
    alpha: float = 0.5
    mode: str = "fixed"
    adaptive: float = 0.05


FIELDS = "trial long, bm25_k int, vec_k int, rrf_k int, rerank_k int, threshold double, final_k int, fusion string, alpha double, mode string, adaptive double"


def trial_documents(trials: DataFrame, lexical: DataFrame, vector: DataFrame, scores: DataFrame) -> DataFrame:
    """(trial, qid, doc_id, rank) of all trials over all questions in one plan. The lists hold the greatest k of any trial, and each
    (qid, doc_id) is scored once (scores: rr_score), however many trials look at it. Trials are few; candidates don't move for them."""
    both = fusion.candidates(lexical, vector).drop("cand_pos").join(scores.select("qid", "doc_id", "rr_score"), ["qid", "doc_id"], "left")
    rows = both.crossJoin(F.broadcast(trials))
    cut = rows.withColumns({"bm_rank": F.when(F.col("bm_rank") <= F.col("bm25_k"), F.col("bm_rank")), "vec_rank": F.when(F.col("vec_rank") <= F.col("vec_k"), F.col("vec_rank"))}).where("bm_rank IS NOT NULL OR vec_rank IS NOT NULL")
    one = lambda x: F.coalesce(x, F.lit(0.0))
    rrf = one(1.0 / (F.col("rrf_k") + F.col("bm_rank"))) + one(1.0 / (F.col("rrf_k") + F.col("vec_rank")))
    mixed = F.col("alpha") / F.coalesce("vec_rank", F.lit(1000)) + (1 - F.col("alpha")) / F.coalesce("bm_rank", F.lit(1000))
    group = Window.partitionBy("trial", "qid")
    fused = cut.withColumn("fused", F.round(F.when(F.col("fusion") == "weighted", mixed).otherwise(rrf), 6))
    placed = fused.withColumn("place", F.row_number().over(group.orderBy(F.desc("fused"), F.col("bm_rank").asc_nulls_last(), F.col("vec_rank").asc_nulls_last(), "doc_id")))
    pooled = placed.where(F.col("place") <= F.least(F.col("bm25_k") + F.col("vec_k"), F.col("rerank_k"))).withColumn("rr_score", one(F.col("rr_score")))
    ranked = pooled.withColumn("rank", F.row_number().over(group.orderBy(F.desc("rr_score"), "place")))
    keep = F.when(F.col("mode") == "adaptive", F.col("rr_score") >= F.col("adaptive")).otherwise(F.col("rr_score") > F.col("threshold"))
    return ranked.where(keep & (F.col("rank") <= F.col("final_k"))).select("trial", "qid", "doc_id", "rank")


def trial_metrics(trials: DataFrame, documents: DataFrame, relevance: DataFrame, questions: DataFrame) -> DataFrame:
    """(trial, context_relevance, docs): the mean over all questions of their documents' mean relevance (qid, doc_id, relevance); a
    question that a trial finds nothing for counts as 0."""
    each = documents.join(relevance, ["qid", "doc_id"], "left").groupBy("trial", "qid").agg(F.avg(F.coalesce("relevance", F.lit(0.0))).alias("cr"), F.count(F.lit(1)).alias("docs"))
    every = trials.select("trial").crossJoin(questions.select("qid"))
    return every.join(each, ["trial", "qid"], "left").groupBy("trial").agg(F.round(F.avg(F.coalesce("cr", F.lit(0.0))), 6).alias("context_relevance"), F.sum(F.coalesce("docs", F.lit(0))).alias("docs"))


def leading(rows: DataFrame, order: str, keep: Column, group: str = "qid") -> DataFrame:
    """Of each group the rows before the first that fails."""
    flag = F.min(F.when(keep, F.lit(1)).otherwise(F.lit(0))).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_flag", flag).where("_flag = 1").drop("_flag")


def nonblank(rows: DataFrame, text: str = "text") -> DataFrame:
    """Rows with text."""
    return rows.where(X.strip(F.col(text)) != "")


def grouped_labels(pairs: DataFrame) -> DataFrame:
    """(query, documents, labels) of pairs, in the order of documents."""
    made = pairs.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("document", "label"))).alias("r"))
    return made.select("query", F.transform("r", lambda x: x["document"]).alias("documents"), F.transform("r", lambda x: x["label"]).alias("labels"))


def with_parents(chunks: DataFrame) -> DataFrame:
    """Chunks with the text of their parent, null where it has no row."""
    parents = chunks.select(F.col("chunk_id").alias("parent_id"), F.col("text").alias("parent_text")).where("parent_id IS NOT NULL").dropDuplicates(["parent_id"])
    return chunks.join(parents, "parent_id", "left")


def sanity(vectors: DataFrame, question: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest rows of one question."""
    from tessella.operators.vectors import cosine_top_k

    return cosine_top_k(vectors, question.limit(1), k)
