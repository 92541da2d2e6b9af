"""Hand-made rows for the traps and the branches that the supplied tables don't reach."""

import json
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.functions import official as O
from tessella.functions import text as X
from tessella.functions import urls as U
from tessella.operators import ask, bm25, chunking, clauses, context, fusion, metrics, mining, relational, search, vectors
from tessella.plans.queries import QUERIES
from tessella.sources import readers, sinks
from tessella.streaming import ingest


def one(spark, expr, value=None):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (X.strip, " a\xa0", "a"),
        (X.strip, None, ""),
        (X.clean_text, "a\xa0\t b \n\n\n\n c", "a b\n\n c"),
        (X.clean_text, "a\n \n \n b", "a\n\n\n b"),
        (lambda c: X.lenient_int(c, 7), "3.7", 3),
        (lambda c: X.lenient_int(c, 7), "abc", 7),
        (lambda c: X.lenient_int(c, 7), "", 7),
        (lambda c: X.lenient_int(c, 7), None, 7),
        (X.rate_code, "код 01-02-003-04 и 05-06-007-08", "01-02-003-04"),
        (X.rate_code, "101-02-003-045", ""),
        (X.strip_part, "Title Часть 2", "Title"),
        (X.strip_part, " Title ЧАСТИ 10 ", "Title"),
        (X.clean_page, "exam-\n ple\r one\n\n\n\ntwo  x", "example one\n\ntwo x"),
        (X.clean_page, "©б утверждении Страница 3 из 9 и DOCS.cntd.ru\nx", "Об утверждении и \nx"),
        (X.clean_page, None, ""),
        (X.clean_page, "a DOCS.CNTD.RU b ᲃтраница 1 МИНСТРОЙ\tРоссии №5/ПР c", "a b c"),
        (X.clean_page, "a-\nb-\nc x-\n y", "ab-\nc xy"),
        (X.strip, "\u3000\x85\u2028 a\x1c\u200a\n", "a\x1c"),
        (lambda c: F.regexp_replace(c, X.guarded(["x?a", "b"]), ""), "xab", ""),
        (X.drop_notes, "a (в редакции от 1) b (см. c)", "ab (см. c)"),
        (X.drop_stamps, "a\n\n сведения  сформированы фгис цс \r\nb", "a\nb"),
        # Trap Q1: an end after an ordinary word of three letters or more doesn't split; after a quote or two letters it does.
        (lambda c: X.truncate_sentences(c, 12), "Aaaa. Bbbb. Cccc.", "Aaaa. Bbbb. " + O.CUT),
        (lambda c: X.truncate_sentences(c, 14), 'Aa ab". Bb cd". Cc ef".', 'Aa ab".' + O.CUT),
        (lambda c: X.truncate_sentences(c, 15), 'Aa ab". Bb cd". Cc ef".', 'Aa ab".Bb cd".' + O.CUT),
        (lambda c: X.truncate_sentences(c, 15, True), 'Aa ab". Bb cd". Cc ef".', 'Aa ab". Bb cd".' + O.CUT),
        (lambda c: X.truncate_sentences(c, 4), "Aaaaaaa. B.", "Aaaa" + O.CUT),
        (lambda c: X.truncate_sentences(c, 99), " short ", "short"),
        (lambda c: X.truncate_sentences(c, 0), "any length", "any length"),
        (X.scoring_sentences, 'Это первое "слово". 12 345, 678 9 10 11 12". Это второе слово и ещё', ['Это первое "слово".', "Это второе слово и ещё"]),
        (X.drafted, "text\n источники \n\nmore", "Ответ: textmore"),
        (X.drafted, "text\nИсточники:\n- a\nВопрос: q", "Ответ: text\nИсточники:\n- a"),
        (X.drafted, "ОТВЕТ да", "ОТВЕТ да"),
        (X.drafted, " ", ""),
        (X.embedder_text, "a", "search_document: a"),
        (U.slug, "https://a/b/c/", "c"),
        (U.slug, "https://a", None),
        (U.question_id, "https://h/x/questions/5/77/", "5_77"),
        (U.question_id, "https://h/questions/5/77", None),
        (U.normalise, "https://h//a//b.html/#x", "https://h/a/b.html"),
        (U.question_path, "questions/5/77", "/questions/5/77/"),
        (U.question_path, "https://h/a//questions/5/77/?q", "/a/questions/5/77/"),
        (U.question_path, "/other/5", None),
        (U.last_page, "?PAGEN_1=3 ?PAGEN_1=12", 12),
        (U.last_page, "none", 1),
    ],
)
def test_scalars(spark, f, given, want):
    assert one(spark, f, given) == want


def test_quality_and_pages(spark):
    assert one(spark, X.quality, "").noisy is True
    assert one(spark, X.quality, "12345 ab") == (8, 0.25, 0.625, True)
    assert one(spark, X.page_range, "<<<PAGE:2>>> x <<<PAGE:10>>>") == (2, 10)
    assert one(spark, X.page_range, "x") == (0, 0)
    assert one(spark, X.strip_page_marks, "a<<<PAGE:2>>>\nb") == "a\nb"


def test_finish_answer(spark):
    label = lambda *c: X.source_label(*map(F.lit, c))
    row = spark.range(1).select(label("01", "Title Часть 2", "f.pdf", "3.1", "7").alias("a"), label("", "T", "", "", "").alias("b"), label("", "", "g", None, "2").alias("c")).first()
    assert tuple(row.a) == ("01", "Title", "f.pdf", " (п. 3.1, стр. 7)") and row.b.anchor == ""
    made = spark.createDataFrame([row]).select(X.finish_answer(F.lit("text "), F.array("a", "b", "c", "a")).alias("y")).first().y
    assert made == "Ответ: text\n\nИсточники:\n- [01] Title— f.pdf (п. 3.1, стр. 7)\n- T\n- Документ— g (стр. 2)"
    assert [X.optional_dims(v) for v in ("64 # dims", "0", "", None, "x", "# 5")] == [64, None, None, None, None, None]
    e = spark.range(1).select(X.coerced(F.array(F.lit("я"), F.lit(None)), "array<string>").alias("a"), X.coerced(F.lit(2.5), "double").alias("b"), X.coerced(F.to_date(F.lit("2024-01-02")), "date").alias("c")).first()
    assert tuple(e) == ('["я",null]', 2.5, "2024-01-02")


def lists(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (1, 12, 3)], "qid int, doc_id long, rank int")
    b = spark.createDataFrame([(1, 12, 1), (1, 11, 2), (1, 13, 3)], "qid int, doc_id long, rank int")
    return a, b


def test_fusion(spark):
    a, b = lists(spark)
    got = [r.doc_id for r in fusion.fused(fusion.candidates(a, b), fusion.Settings(rrf_k=1)).orderBy("fused_rank").collect()]
    assert got == [12, 11, 10, 13]  # 0.75, 0.667, 0.5, 0.25
    swapped = {r.doc_id: r.fused for r in fusion.fused(fusion.candidates(b, a), fusion.Settings(rrf_k=1)).collect()}
    assert swapped == {r.doc_id: r.fused for r in fusion.fused(fusion.candidates(a, b), fusion.Settings(rrf_k=1)).collect()}
    w = {r.doc_id: r.fused for r in fusion.fused(fusion.candidates(a, b), fusion.Settings(fusion="weighted", alpha=0.5)).collect()}
    assert w[10] == pytest.approx(0.5 + 0.0005) and w[12] == pytest.approx(0.5 + 1 / 6, abs=1e-6)


def test_selection_traps(spark):
    rows = spark.createDataFrame([(1, 1, 0.3, 1), (1, 2, 0.2, 2), (1, 3, 0.0, 3)], "qid int, doc_id int, rr_score double, rr_rank int")
    take = lambda **k: [r.doc_id for r in fusion.selected(rows, fusion.Settings(**k)).orderBy("rr_rank").collect()]
    assert take(threshold=0.2) == [1] and take(mode="adaptive", adaptive_threshold=0.2) == [1, 2]
    a, b = lists(spark)
    failed = fusion.hybrid(a, b, lambda p: p.withColumn("rr_score", F.lit(None).cast("double")), fusion.Settings())
    assert failed.count() == 0  # all scores 0 under a threshold above it
    kept = fusion.hybrid(a, b, lambda p: p.withColumn("rr_score", F.lit(None).cast("double")), fusion.Settings(threshold=-1, rrf_k=1))
    assert [r.doc_id for r in kept.orderBy("rr_rank").collect()] == [12, 11, 10, 13]


def test_bm25(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a b", "a c", "a", "d d"])], "doc_id long, text string")
    index = bm25.build_index(docs)
    idf = {r.term: r.idf for r in index.terms.collect()}
    assert idf["a"] == pytest.approx(0.25 * np.mean([np.log(1.5 / 3.5), *[np.log(3.5 / 1.5)] * 3]))  # negative: floored
    q = spark.createDataFrame([(1, "b b zz")], "qid int, text string")
    assert [r.doc_id for r in bm25.retrieve(index, q, 3).collect()] == [0]
    assert [r.doc_id for r in bm25.retrieve(index, q, 3, docs).orderBy("rank").collect()] == [0, 1, 2]


def test_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [0.0, 0.0])], "vec_id int, embedding array<float>")
    q = spark.createDataFrame([(9, [0.0, 1.0])], "qid int, embedding array<float>")
    assert [(r.vec_id, r.distance) for r in vectors.cosine_top_k(rows, q, 2).orderBy("rank").collect()] == [(2, 0.0), (1, 1.0)]
    assert rows.where("vec_id = 2").select(vectors.normalised(F.col("embedding"), 1).alias("v")).first().v == [0.0]


def test_relational(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, pos int, v string")
    assert sorted(r.v for r in relational.first_wins(rows, ["k"], ["pos"]).collect()) == ["y", "z"]
    old = spark.createDataFrame([("a", 0, "old"), ("c", 0, "old")], "k string, pos int, v string")
    assert sorted(r.v for r in relational.upsert(old, rows, "k", ["pos"]).collect()) == ["old", "y", "z"]
    assert relational.sample_by_hash(rows, ["k", "pos"], 2).count() == 2
    assert relational.split_by_hash(rows, ["k"]).where("is_train IS NULL").count() == 0


def test_context(spark):
    rows = spark.createDataFrame([(1, 1, "a" * 10), (1, 2, " "), (1, 3, "b" * 10), (1, 4, "c"), (2, 1, "d" * 11), (3, 1, "e" * 26)], "qid int, rank int, block string")
    got = {r.qid: (r.context, r.blocks) for r in context.contexts(rows, 25).collect()}  # 10 + 5 + 10: the first block has no separator
    assert got == {1: ("a" * 10 + context.SEPARATOR + "b" * 10, 2), 2: ("d" * 11, 1), 3: ("", 0)}
    none = F.array().cast("array<struct<work_code:string,title:string,source_file:string,anchor:string>>")
    given = spark.createDataFrame([(1, "q", ""), (2, "q", "x" + context.SEPARATOR + "y"), (3, "bad", "x")], "qid int, question string, context string").withColumn("sources", none)
    generate = lambda p: F.when(~F.contains(p, F.lit("bad")), context.extractive(p))
    assert [r.answer for r in context.answered(given, generate).orderBy("qid").collect()] == [O.NO_DATA, "Ответ: x", O.FAILED]


def test_docs_to_context(spark, sf):
    long = 'A sentence of words". ' * 900
    rows = [(1, 1, long, "01", "T Часть 1", "f"), (1, 2, "b", "", "", ""), (2, 1, " \n", "", "", None), (3, 1, None, "", "U", "")]
    got = {r.qid: r for r in context.docs_to_context(spark.createDataFrame(rows, "qid int, rank int, text string, work_code string, title string, source string"), 5_200).collect()}
    assert got[1].blocks == 2 and got[1].context.startswith("[01] T\nДокумент: f\nA sentence") and got[1].context.endswith(O.CUT + context.SEPARATOR + "b")
    assert (got[2].context, got[2].blocks) == ("", 0) and got[3].context == "[] U"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    built = QUERIES["context_build"](spark, sf).collect()
    assert len(built) == docs.select("source").distinct().count() and all(r.blocks > 0 for r in built)


def test_recursive_split():
    split = chunking.recursive_split
    assert split("short", 10, 2) == ["short"]
    assert split("aaaa bbbb cccc", 10, 4) == ["aaaa bbbb", "cccc"]
    assert split("x" * 25, 10, 0) == ["x" * 10, "x" * 10, "x" * 5]
    text = "\n\n".join(f"para {k} " + "word " * 30 for k in range(20))
    assert all(len(p) <= 300 for p in split(text, 300, 60))


def test_chunks_are_cleaned_first(spark):
    docs = spark.createDataFrame([(1, "a\xa0\xa0" * 2000 + "b"), (2, " \n "), (3, None), (4, "short"), (5, "w " * 1400)], "doc_id long, text string")
    parts = chunking.recursive_chunks(docs.where("doc_id < 5")).collect()
    assert {r.doc_id for r in parts} == {1, 4} and parts[0].chunk == ("a " * 750).strip()
    whole = {r.chunk_id: r for r in chunking.merge_split(docs, least=3).collect()}
    assert set(whole) == {"1__p1", "1__p2", "1__p3", "1__p4", "4", "5"} and len(whole["5"].chunk) == 2799


def test_sentences():
    assert chunking.split_sentences("One. Two! Three?Four.\n So") == ["One. Two!", "Three?", "Four. So"]
    assert chunking.split_sentences(". a? !") == [".", "a?", "!"] and chunking.split_sentences("") == []
    assert chunking.force_split("", 10) == [""]
    assert all(len(p) <= 50 for p in chunking.force_split("word " * 100, 50))
    assert [len(x) for x in chunking.force_split("y" * 3000, 1500)] == [3000]  # a single sentence is packed by words only
    assert [len(x) for x in chunking.force_split("y" * 3000 + "! z", 1500)] == [1500, 1500, 201, 1]
    assert [len(x) for x in chunking.force_split("y" * 900 + "! z", 500)] == [500, 500, 101, 1]  # windows follow the limit
    merged = chunking.merge_small([{"parent_id": "p", "subclause": None, "text": "a" * 5, "page_end": 1}, {"parent_id": "p", "subclause": None, "text": "b" * 5, "page_end": 3}, {"parent_id": "p", "subclause": None, "text": "c"}, {"parent_id": "q", "subclause": None, "text": "d"}], 10)
    assert [(m["text"], m.get("page_end")) for m in merged] == [("aaaaa bbbbb", 3), ("c", None), ("d", None)]


def test_clauses():
    body = "у этого пункта текст, которого хватает на отдельный фрагмент."
    text = f"<<<PAGE:1>>>\nвводные слова, которых хватает на отдельный фрагмент текста здесь.\n1. Первый {body}\n2. Второй (в редакции 1) {body}\n3. Ещё {body}\n1. Снова:\nа) {body}\nб) коротко\n2) {body} <<<PAGE:4>>>\nТаблица 1 Итоги {body}\n"
    rows = {r[0]: r for r in clauses.clause_rows(text, "d")}
    assert list(rows) == ["d__0", "d__1", "d__2", "d__3", "d__1_2__а", "d__1_2__2", "d__1_3"]  # tables share the counter
    assert rows["d__0"][4:10] == (O.INTRODUCTION, 1, None, False, 1, 1)
    assert rows["d__1"][10] == f"1. Первый {body}" and rows["d__2"][10] == f"2. Второй{body}" and rows["d__1"][4] == f"Первый {body}"
    assert rows["d__1_2__а"][2:10] == ("1_2", "а", "Снова:", 2, "d__1_2", False, 4, 4) and rows["d__1_2__2"][10] == f"2) {body}"
    assert rows["d__1_3"][4] == f"Итоги {body}" and "d__1_2" not in rows  # a short beginning has no row (trap Q26)
    assert [r[0] for r in clauses.clause_rows(f"1. Первый {body} и буква\n2. Второй {body}", "d")] == ["d__1"]  # trap Q5
    assert [(r[0], r[4], r[8]) for r in clauses.clause_rows(body, "d")] == [("d__0", O.WHOLE, 0)]
    long = list(clauses.clause_rows(f"1. {'слово! ' * 300}\nа) {body}", "d"))
    assert [r[0] for r in long] == ["d__1.1", "d__1.2", "d__1__а"] and long[0][7] and max(len(r[10]) for r in long) <= 1500
    assert [s[1] for s in clauses.sub_boundaries("а) x\nв) y\nа) z\nб) w\n1) q\nБ) r")] == ["а", "в", "б", "1", "Б"]
    assert list(clauses.clause_rows("  ", "d")) == [] and list(clauses.clause_rows(None, "d")) == []


def test_ndcg(spark):
    rows = spark.createDataFrame([(1, 0.9, 0), (1, 0.1, 1), (2, 0.5, 1), (3, 0.5, 0), (3, 0.4, 0), (4, 0.5, 1), (4, 0.5, 0)], "qid int, score double, relevance int")
    got = {r.qid: r.ndcg for r in metrics.ndcg(rows).collect()}
    assert got[1] == pytest.approx(1 / np.log2(3), abs=1e-6) and 2 not in got and got[3] == 0 and got[4] == pytest.approx((1 + 1 / np.log2(3)) / 2, abs=1e-6)


def test_pareto(spark):
    rows = spark.createDataFrame([(1, 1.0, 3.0), (2, 2.0, 2.0), (3, 1.0, 2.0), (4, 2.0, 2.0)], "t int, a double, b double")
    assert sorted(r.t for r in metrics.pareto_front(rows, ["a", "b"]).collect()) == [1, 2, 4]
    assert metrics.pareto_front(rows.limit(0), ["a", "b"]).count() == 0
    points = np.random.default_rng(1).integers(0, 12, (300, 3)).astype(float)
    levels, left = [], list(range(300))
    while left:
        levels.append([i for i in left if not any((points[j] >= points[i]).all() and (points[j] > points[i]).any() for j in left)])
        left = [i for i in left if i not in levels[-1]]
    assert search.fronts(points) == levels


def test_quantiles(spark):
    values = [(None, 1.0), (None, None)] + [(k % 3, float(x)) for k, x in enumerate(np.random.default_rng(2).integers(0, 50, 400))] + [(7, 5.0)] * 3 + [(8, x) for x in (1.0, 1e9, 1e9 + 1)]
    rows = spark.createDataFrame(values, "g int, v double")
    for bins in (2, 1024):
        got = {r.g: (r.q0, r.q1, r.q2) for r in metrics.quantiles(rows, "g", "v", (0.25, 0.5, 0.95), bins).collect()}
        want = {g: tuple(np.quantile([v for h, v in values if h == g and v is not None], (0.25, 0.5, 0.95))) for g in {g for g, _ in values}}
        assert set(got) == set(want) and all(np.allclose(got[g], want[g]) for g in want)


def test_faithfulness(spark):
    rows = spark.createDataFrame([(1, 0.2), (1, 0.4), (2, None)], "qid int, p_unsupported double")
    assert {r.qid: round(r.faithfulness, 6) for r in metrics.faithfulness(rows).collect()} == {1: 0.7, 2: 1.0}


def test_mining(spark):
    ranked = spark.createDataFrame([(1, 100 + k, k) for k in range(1, 200)], "qid int, doc_id long, rank int")
    got = mining.hard_negatives(ranked, spark.createDataFrame([(1, 112)], "qid int, doc_id long"))
    assert [r.doc_id for r in got.orderBy("neg_rank").collect()] == [111, 113, 114, 115, 116, 117, 118]
    positives = spark.createDataFrame([(q, q) for q in range(20)], "qid long, doc_id long")
    drawn = mining.random_negatives(positives, spark.range(50).withColumnRenamed("id", "doc_id")).collect()
    assert len(drawn) == 60 and all(r.doc_id != r.qid for r in drawn)
    several = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 9)], "qid long, doc_id long")
    few = mining.random_negatives(several, spark.range(4).withColumnRenamed("id", "doc_id"))  # min(n, candidates) each
    assert {(r.qid, r.positive): r["count"] for r in few.groupBy("qid", "positive").count().collect()} == {(1, 0): 2, (1, 1): 2, (2, 0): 3, (3, 9): 3}
    assert few.select("qid", "positive", "doc_id").distinct().count() == few.count()
    assert mining.random_negatives(several, spark.range(0).withColumnRenamed("id", "doc_id")).count() == 0
    assert mining.share_by_hash(spark.range(1000), ["id"], 0.37).count() == 370


def test_ask(spark):
    chunks = spark.createDataFrame([(1, "первый текст", "01-02-003-04", "T", "f", None, None), (2, "второй текст", "", "", "", None, None), (3, "третий", "", "", "", None, None)], "doc_id long, text string, work_code string, title string, source string, clause string, page string")
    questions = spark.createDataFrame([(1, "что о 01-02-003-04"), (2, "второй"), (3, "ничего")], "qid long, question string")
    lists = [spark.createDataFrame([(q, d, k) for q, d, k in rows], "qid long, doc_id long, rank int") for rows in ([(1, 2, 1), (1, 3, 2), (2, 2, 1)], [(2, 3, 1)])]
    score = lambda pool: pool.withColumn("rr_score", F.lit(0.5))
    got = {r.qid: r for r in ask.ask(questions, *lists, chunks, score, fusion.Settings(final_k=3)).collect()}
    assert (got[1].docs_count, got[1].meta.mode, got[1].meta.top_scores) == (3, "exact_code_match", None) and got[1].contexts[0] == "первый текст"
    assert got[1].sources[0].work_code == "01-02-003-04" and "- [01-02-003-04] T— f" in got[1].answer
    assert (got[2].docs_count, got[2].meta.bm25, got[2].meta.vec, got[2].meta.top_scores) == (2, 1, 1, [0.5, 0.5])
    assert (got[3].answer, got[3].docs_count, got[3].contexts) == (O.NO_DATA, 0, [])
    results = ask.referenced(questions, questions.where("qid = 2").withColumn("reference", F.col("question"))).join(spark.createDataFrame(list(got.values())).select("qid", "answer", "contexts"), "qid")
    made = {r.qid: r for r in ask.triad(results, vectors.hashed, missing=(0.0, 0.5, 0.5)).collect()}
    assert (made[3].context_relevance, made[3].faithfulness) == (0.0, 0.5) and made[2].context_relevance > 0
    judged = {r.qid: r.faithfulness for r in ask.judged(results, lambda s, c: F.lit(None).cast("double")).collect()}
    assert judged == {1: 0.0, 2: 0.0, 3: 0.0}  # a failed judge counts as unsupported, no sentence as 0
    assert [ask.reranker_kind(m) for m in ("jina-x", "Qwen3", "nemotron", "bge")] == ["jina", "causal_lm", "sequence", "cross_encoder"] and ask.reranker_kind("x", "jina") == "jina"
    rows = spark.createDataFrame([(1, 1, 0.9), (1, 2, None), (1, 3, 0.8)], "qid int, rank int, s double")
    assert [r["rank"] for r in ask.leading(rows, "rank", F.col("s") >= 0.5).collect()] == [1]


def test_search():
    space = search.Space(ints={"k": (1, 50)}, floats={"t": (0.0, 1.0)}, choices={"m": ("a", "b")})
    calls = []

    def evaluate(ps):
        calls.append(len(ps))
        return [(-abs(p["k"] - 20) / 50, -abs(p["t"] - 0.5), float(p["m"] == "b")) for p in ps]

    base = {"k": 5, "t": 0.9, "m": "a"}
    trials = search.search(space, evaluate, base, population=12, generations=10)
    assert len(trials) == 120 and len(calls) <= 10
    assert trials == search.search(space, evaluate, base, population=12, generations=10)
    top = search.best(trials, (1.0, 1.2, 1.1), base)
    assert top["values"][2] == 1.0
    with pytest.raises(ValueError):
        search.search(space, evaluate, base, population=1)


def test_sources(spark, tmp_path):
    lines = ['{"chunk_id":"a","text":"t","metadata":{"type":"x","work_code":"w","page_start":"3.9"}}', "{bad", "", "[1]", '{"chunk_id":"","text":"t"}', '{"chunk_id":"b","text":" u ","metadata":null}']
    (tmp_path / "c.jsonl").write_text("\n".join(lines))
    rows = {r.chunk_id: r for r in readers.chunks(spark, str(tmp_path / "c.jsonl")).collect()}
    assert set(rows) == {"a", "b"} and rows["a"].doc_type == "x" and rows["a"].page_start == 3 and rows["b"].doc_type == "unknown" and rows["b"].text_length == 3
    (tmp_path / "q.csv").write_text('Question,Answer,URL\n"a ""q""","line\nline",u\n,,v\nb,c,w\n')
    (tmp_path / "r.csv").write_text("Question,Answer,URL\nx,y,https://h/a/questions/5/77\n")
    assert sorted((r.row, r.question, r.answer, r.qa_id) for r in readers.qa_csv(spark, str(tmp_path / "*.csv")).collect()) == [(1, 'a "q"', "line\nline", "1"), (1, "x", "y", "5_77"), (3, "b", "c", "3")]
    xml = '<base BaseName="B"><Section Type="x"><Section Type="Таблица" Code="T1" Name="N"><NameGroup BeginName="begin"><Work Code="01" EndName="end" MeasureUnit="m"><Content><Item Text="i1"/><Item Text=" "/></Content><Resources><Resource Code="r" EndName="n" Quantity="2"/></Resources><NrSp><ReasonItem Nr="1" Sp="2"/></NrSp></Work><Work Code="02"/></NameGroup></Section></Section></base>'
    (tmp_path / "n.xml").write_text(xml)
    (tmp_path / "a.xml").write_text(xml.replace("base", "NewDataSet"))
    (tmp_path / "o.xml").write_text(xml)
    norms = {r.chunk_id: r for r in readers.norms_xml(spark, str(tmp_path)).collect()}
    assert sorted(norms) == ["fsnb_0", "fsnb_1", "fsnb_2", "fsnb_3"] and norms["fsnb_2"].source_file == "o.xml"
    assert norms["fsnb_0"].text == "НОРМАТИВ: 01 begin end\nЕдиница измерения: m\nСборник: B | Таблица T1 N\n\nСОДЕРЖАНИЕ РАБОТЫ:\ni1\n\nРЕСУРСЫ:\nr n — 2\n\nНОРМАТИВНЫЕ ССЫЛКИ:\nНорма: 1, Спецификация: 2"
    assert norms["fsnb_1"].title == "02 begin" and norms["fsnb_1"].text.count(O.ABSENT) == 3
    page = "<html><nav>n</nav><article class='x'><h1>Что это?</h1><p>ЧТО ЭТО? Ответ из многих слов<br>и строк</article><footer>f</footer>"
    assert readers.heading_and_text(page) == ("Что это?", "ЧТО ЭТО? Ответ из многих слов\nи строк")
    assert readers.heading_and_text("<h1>Q</h1><div class='a content'>answer</div>tail") == ("Q", "answer")
    assert readers.heading_and_text("<h1>Q</h1>text<article></article>") == ("Q", "")
    # A reference that was cut off is text; whole ones are read.
    assert readers.heading_and_text("<h1>a&amp;&amp</h1>x &lt;&#x41;&#66; &nosuch; &ampx & y") == ("a&&amp", "x <AB &nosuch; &ampx & y")
    marked = "<p>x</p><p>ВОПРОС: Первая строка<br>Правда?<br>Ответ тут<br>и тут</p><p>Распечатать</p>"
    assert readers.marked_block(marked) == ("Первая строка Правда?", "Ответ тут\nи тут") and readers.marked_block("x") == ("", "")
    assert readers.html_text("<p>a<script>x</script></p><b> b </b>") == "a\nb"
    made = readers.generated_questions(spark.createDataFrame([("x" * 80,), ("y",)], "text string"), lambda t: "what.").collect()
    assert [r.question for r in made] == ["what?"]


def test_pages(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"x")
    files = spark.read.format("binaryFile").load(str(tmp_path / "f.bin"))
    plain = "слова, которых хватает на страницу без всякой помощи " * 3
    pages = ["", "1 2 3 4 5 6 7 8 9 10 11 12", f"{plain}\n\nсведения сформированы фгис цс"]
    read = lambda ocr, **k: [(r.mode, r.text) for r in readers.page_texts(files, lambda _: iter(pages), ocr, **k).orderBy("page").collect()]
    assert read(None) == [("empty", ""), ("text", pages[1]), ("text", plain.strip())]
    assert [m for m, _ in read(lambda _, n: "o" * 60)] == ["ocr", "ocr", "text"]
    assert [m for m, _ in read(lambda _, n: "o" * 60, most_ocr=1)] == ["ocr", "text", "text"]
    assert [m for m, _ in read(lambda _, n: "o" * 20)] == ["empty", "text", "text"] and [m for m, _ in read(lambda _, n: 1 / 0)] == ["empty", "text", "text"]

    def breaks(_):
        yield plain
        raise ValueError

    assert [r.mode for r in readers.page_texts(files, breaks).orderBy("page").collect()] == ["text", "error"]
    made = readers.page_texts(files, lambda _: iter(["Заголовок документа, который годится\n" + plain, "<x>", plain * 2]))
    (doc,) = readers.documents_of_pages(made).collect()
    assert (doc.doc_id, doc.source, doc.title, doc.extraction) == ("f", "f.bin", "Заголовок документа, который годится", "mixed") and doc.text.startswith("<<<PAGE:1>>>\n")
    (chunk,) = readers.official_chunks(made).collect()
    assert (chunk.chunk_id, chunk.page_start, chunk.page_end, chunk.char_count) == ("f__0", 1, 3, len(chunk.text))
    untitled = made.withColumn("head", F.lit("short"))
    assert readers.documents_of_pages(untitled).first().title == "f"


def test_sinks_and_stream(spark, tmp_path):
    path = str(tmp_path / "coll")
    new = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "chunk_id string, text string")
    assert sinks.count_or_none(spark, path) is None
    assert sinks.load_collection(spark, new, path) and sinks.count_or_none(spark, path) == 2
    assert not sinks.load_collection(spark, new, path, enough=1)
    assert sinks.load_collection(spark, spark.createDataFrame([("b", "9")], "chunk_id string, text string"), path)
    assert {r.chunk_id: r.text for r in spark.read.parquet(path).collect()} == {"a": "1", "b": "9"}
    (tmp_path / "coll").rename(tmp_path / "coll.old")  # a replacement that broke off between its renames
    assert sinks.count_or_none(spark, path) == 2
    sinks.write_json_lines(new, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    sinks.write_csv(new, str(tmp_path / "v"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps(x) for x in [{"chunk_id": "c", "text": "s"}, {"chunk_id": "c", "text": "s"}, {"text": "z"}]))
    stream = ingest.stream_chunks(spark, str(tmp_path / "in"), "chunk_id string, text string")
    ingest.upsert_stream(stream, path, str(tmp_path / "ck")).awaitTermination(60)
    assert {r.chunk_id for r in spark.read.parquet(path).collect()} == {"a", "b", "c"}


def test_blocks_are_bounded_by_lists(spark):
    """a pass holds so many rows of lists at most, and questions named by texts keep their names."""
    asked = spark.createDataFrame([(f"q{n}", "a b") for n in range(5)], "qid string, text string")
    assert [len(b) for b in bm25.blocks(asked, 2, block_rows=4)] == [2, 2, 1]
    docs = spark.createDataFrame([(1, "a c"), (2, "b a b"), (3, None)], "doc_id long, text string")
    got = {(r.qid, r.rank): (r.doc_id, r.score) for r in bm25.shared_terms(docs, asked, 2).collect()}
    assert got == {(f"q{n}", k): (d, s) for n in range(5) for k, d, s in ((1, 2, 2.0), (2, 1, 1.0))}


def test_depth_of_mined_lists(spark):
    """short lists give the same hard negatives, and random ones avoid what is given."""
    long = spark.createDataFrame([(1, 100 + r, r) for r in range(1, 151)], "qid int, doc_id long, rank int")
    positives = spark.createDataFrame([(1, 111), (1, 113)], "qid int, doc_id long")
    every, cut = (sorted(map(tuple, mining.hard_negatives(long.where(F.col("rank") <= k), positives).collect())) for k in (150, mining.depth(2)))
    assert every == cut
    ids = spark.range(6).withColumnRenamed("id", "doc_id")
    avoided = positives.unionByName(spark.createDataFrame([(1, 0), (1, 2), (1, 4)], "qid int, doc_id long"))
    assert {r.doc_id for r in mining.random_negatives(positives, ids, avoided=avoided).collect()} == {1, 3, 5}


def test_frequencies(spark):
    """one pass, and the same words as the SQL's."""
    docs = spark.createDataFrame([("a a b",), ("b\x1cc\xa0a",), (None,)], "text string")
    assert {(r.term, r.df, r.words) for r in bm25.frequencies(docs).collect()} == {("a", 2, 0), ("b", 1, 0), ("b\x1cc", 1, 0), (None, 3, 5)}
    empty = bm25.build_index(docs.where("false").withColumn("doc_id", F.lit(1)))
    assert empty.stats.first().n_docs == 0


def test_batches_are_small(spark):
    """a worker's batch doesn't grow with the table."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    for f in (chunking.recursive_chunks, chunking.merge_split, chunking.sentence_chunks, clauses.clause_chunks, bm25.frequencies):
        spark.conf.set(name, "10000")
        f(docs)
        assert int(spark.conf.get(name)) == relational.ARROW_ROWS


def test_packing_in_parts(spark, monkeypatch):
    """parts of a group are cut first, and the result is that of whole groups; no window sees a group whole."""
    rows = spark.range(3000).select((F.col("id") % 2).alias("qid"), F.col("id").alias("rank"), F.when(F.col("id") == 62, F.repeat(F.lit("y"), 901)).when(F.col("id") % 3 > 0, F.repeat(F.lit("x"), (F.col("id") % 17).cast("int"))).alias("block"))
    many = sorted(map(tuple, context.contexts(rows, 900).collect()))
    monkeypatch.setattr(context, "PARTS", 1)
    assert many == sorted(map(tuple, context.contexts(rows, 900).collect())) and many[0][2] < many[1][2]  # the long block ends its group
    plan = QUERIES["context_build"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "_part" in plan


def test_matching(spark):
    """The ids that are wanted travel, the texts don't."""
    rows = spark.range(100).withColumnRenamed("id", "doc_id")
    got = relational.matching(rows, spark.createDataFrame([(5,), (5,), (7,), (None,)], "doc_id long"), "doc_id")
    assert sorted(r.doc_id for r in got.collect()) == [5, 7]
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_words_in_arrow():
    """a batch of texts is cut at once, into the words that each has alone."""
    texts = ["a  b\tc", None, "", " \xa0a ", "b\x1cc\x1fd e", "\x85x　y\0z ", "ΑΣ ΣΑΣ\xa0İ", "\x1d \x1e"]
    for own in (texts, [t for t in texts if not set(t or "") & set("\x1c\x1d\x1e\x1f")]):
        for lower in (False, True):
            want = [bm25.words_of((t or "").lower() if lower else t) for t in own]
            for column in (pa.array(own, pa.string()), pa.array([None, "q r", *own, "s"], pa.large_string()).slice(2, len(own))):
                lengths, words = bm25.split_words(column, lower)
                assert (lengths.tolist(), words.to_pylist()) == ([len(w) for w in want], [w for ws in want for w in ws])


def test_terms_held(monkeypatch):
    """a term of many documents leaves a task once, though the task sends terms of one document early."""
    monkeypatch.setattr(bm25, "HELD_TERMS", 200)
    texts = [f"common word rare{n} rare{n} odd{n % 300}" for n in range(3000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 100])], names=["text"]) for k in range(0, 3000, 100)]
    rows = [r for b in bm25._counted(iter(batches)) for r in b.to_pylist()]
    df = Counter()
    for r in rows:
        df[r["term"]] += r["df"]
    assert df == Counter(w for t in texts for w in set(t.split())) + Counter({None: 3000})
    assert sum(r["words"] for r in rows) == 15_000
    assert [r["df"] for r in rows if r["term"] == "common"] == [3000]


def test_scan_takes_documents_together(monkeypatch):
    """a batch is scored in blocks of bounded cells, not document by document, with the sums of single documents."""
    asked = [Counter("a a b".split()), Counter("c".split()), Counter("b d".split())]
    terms = sorted({t for q in asked for t in q})
    cells = sorted((terms.index(t), n, 0.1 * (len(t) + n) * c) for n, q in enumerate(asked) for t, c in q.items())
    starts = np.searchsorted([c[0] for c in cells], np.arange(len(terms) + 1))
    docs = [" ".join("abcdefg"[(n * k) % 7] for k in range(n % 11)) for n in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(docs)], names=["doc_id", "text"])
    calls = []

    def saturate(tf, dl):
        calls.append(len(tf))
        return tf / (tf + 0.5 + 0.01 * dl)

    want = []
    for n, q in enumerate(asked):
        scored = []
        for d, text in enumerate(docs):
            tf = Counter(text.split())
            if tf.keys() & q.keys():
                scored.append((-round(sum(0.1 * (1 + n) * q[t] * tf[t] / (tf[t] + 0.5 + 0.01 * len(text.split())) for t in sorted(q) if tf[t]), 6), d))
        want += [(n, d, -s) for s, d in sorted(scored)[:5]]
    for most in (1 << 20, 7):
        monkeypatch.setattr(bm25, "CELLS", most)
        run = bm25._scan(3, terms, starts, np.array([c[1] for c in cells]), np.array([c[2] for c in cells]), 5, saturate, False)
        assert [(r["question"], r["doc_id"], pytest.approx(r["score"])) for b in run(iter([batch])) for r in b.to_pylist()] == want
    assert len(calls) == 2
