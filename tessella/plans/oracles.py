"""Equivalent SQL (DuckDB) of the registered queries, written independently of the DataFrame plans."""

_TOKENS = r"list_filter(string_split_regex({0}, '\s+'), lambda x: x <> '')"
_BM25 = f"""
w AS (SELECT doc_id, {_TOKENS.format('text')} AS ws FROM documents),
p AS (SELECT term, doc_id, dl, count(*) AS tf FROM (SELECT doc_id, len(ws) AS dl, unnest(ws) AS term FROM w) GROUP BY term, doc_id, dl),
c AS (SELECT count(*) AS n, avg(len(ws)) AS avgdl FROM w),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
r AS (SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS raw FROM f, c),
m AS (SELECT avg(raw) AS mean FROM r),
i AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * mean ELSE raw END AS idf FROM r, m),
q AS (SELECT qid, term, count(*) AS qtf FROM (SELECT item_id AS qid, unnest({_TOKENS.format('text')}) AS term FROM benchmark) GROUP BY qid, term),
s AS (SELECT qid, doc_id, round(sum(qtf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score FROM q JOIN i USING (term) JOIN p USING (term), c GROUP BY qid, doc_id),
bm AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM s)"""
_LISTS = f"""{_BM25},
dw AS (SELECT doc_id, unnest(list_distinct({_TOKENS.format('lower(text)')})) AS w FROM documents),
qw AS (SELECT item_id AS qid, unnest(list_distinct({_TOKENS.format('lower(text)')})) AS w FROM benchmark),
ov AS (SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY n DESC, doc_id) AS rank FROM (SELECT qid, doc_id, count(*) AS n FROM dw JOIN qw USING (w) GROUP BY qid, doc_id)),
cand AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY b ASC NULLS LAST, v ASC NULLS LAST, doc_id) AS pos FROM
  (SELECT coalesce(l.qid, o.qid) AS qid, coalesce(l.doc_id, o.doc_id) AS doc_id, l.rank AS b, o.rank AS v FROM (SELECT * FROM bm WHERE rank <= 30) l FULL JOIN (SELECT * FROM ov WHERE rank <= 30) o ON l.qid = o.qid AND l.doc_id = o.doc_id)),
fu AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY fused DESC, pos) AS fused_rank FROM (SELECT *, {{score}} AS fused FROM cand))"""
_RRF = "round(coalesce(1.0::DOUBLE / (60 + b), 0) + coalesce(1.0::DOUBLE / (60 + v), 0), 6)"
_HYBRID = f"""WITH {_LISTS.format(score=_RRF)},
nq AS (SELECT qid, count(*) AS n FROM qw GROUP BY qid),
sc AS (SELECT fu.qid, fu.doc_id, fused_rank, round(coalesce((SELECT count(*) FROM qw JOIN dw USING (w) WHERE qw.qid = fu.qid AND dw.doc_id = fu.doc_id), 0)::DOUBLE / n, 6) AS rr_score FROM fu JOIN nq ON nq.qid = fu.qid WHERE fused_rank <= 20),
rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rr_score DESC, fused_rank) AS rr_rank FROM sc)
SELECT qid, doc_id, rr_score, rr_rank FROM rk WHERE rr_rank <= 5 AND rr_score {{test}}"""
_VECTORS = """
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len FROM e),
d AS (SELECT a.vec_id AS qid, b.vec_id, round(1 - list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) / (a.len * b.len), 6) + 0.0::DOUBLE AS distance FROM u a, u b WHERE a.vec_id % 100 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, vec_id) AS rank FROM d)"""
_URL = r"""concat(regexp_extract(regexp_replace({0}, '#.*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://)?', 0), regexp_replace(regexp_replace(substr(regexp_replace({0}, '#.*$', ''), length(regexp_extract(regexp_replace({0}, '#.*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://)?', 0)) + 1), '/{{2,}}', '/', 'g'), '\.html/+$', '.html'))"""
_SEGMENTS = r"list_filter(string_split(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1), '/'), lambda x: x <> '')"
_PAIRS = """SELECT conv_id, turn, text AS question, answer FROM (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations)
WHERE role = 'user' AND nr = 'assistant' AND length(text) >= {0} AND length(answer) >= {1}"""

_STRIP = r"regexp_replace({0}, '^[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}]+|[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}]+$', '', 'g')"
_TIDY = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace({0}, chr(160), ' '), '^\s+|\s+$', '', 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', concat(chr(10), chr(10)), 'g'), '[ \t]+\n', chr(10), 'g'), '^\s+|\s+$', '', 'g')"
_ENTITIES = "replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&')"
#: Blocks of r(qid, rank, block) packed into contexts of at most 12,000 characters, five for a separator from the second block on.
_PACK = """s AS (SELECT *, sum(length(block) + 5) OVER (PARTITION BY qid ORDER BY rank ROWS UNBOUNDED PRECEDING) - 5 AS run FROM r WHERE block <> ''),
k AS (SELECT qid, string_agg(block, concat(chr(10), chr(10), '---', chr(10), chr(10)) ORDER BY rank) AS c, count(*) AS n FROM s WHERE run <= 12000 GROUP BY qid),
j AS (SELECT d.qid, coalesce(c, '') AS c, coalesce(n, 0) AS n FROM (SELECT DISTINCT qid FROM r) d LEFT JOIN k ON k.qid IS NOT DISTINCT FROM d.qid)"""
#: Greedy packing of a list of texts, and what is made of a text with it.
_PACKED = "list_reduce(list_transform({parts}, lambda y: [y]), lambda a, y: CASE WHEN length(a[-1]) + 1 + length(y[1]) > {most} THEN list_append(a, y[1]) ELSE list_append(a[:-2], concat(a[-1], ' ', y[1])) END)"
_MERGED = "list_reduce(list_transform({parts}, lambda y: [y]), lambda a, y: CASE WHEN length(a[-1]) + length(y[1]) > {most} THEN list_append(a, y[1]) ELSE list_append(a[:-2], concat(a[-1], ' ', y[1])) END)"
_FLAT = r"regexp_replace({t}, '\s+', ' ', 'g')"
_SENTENCES = rf"list_filter(list_transform(regexp_extract_all({_FLAT}, '\A\.|[^!?]*[!?]|[^!?]+'), lambda y: trim(y)), lambda y: y <> '')"
_FORCED = (
    f"CASE WHEN length({{t}}) <= {{most}} THEN [{{t}}] WHEN len({_SENTENCES}) <= 1 THEN "
    + _PACKED.replace("{parts}", f"list_filter(string_split({_FLAT}, ' '), lambda y: y <> '')")
    + " ELSE flatten(list_transform("
    + _PACKED.replace("{parts}", _SENTENCES)
    + ", lambda h: CASE WHEN length(h) > {most} THEN list_transform(range(0, length(h), {most} - 100), lambda i: trim(substr(h, i + 1, {most}))) ELSE [h] END)) END"
)
def _page(text: str) -> str:
    return _STRIP.format(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(@, chr(13), ' '), chr(160), ' '), '©б', 'Об'), 'Страница\s*3\s*из\s*9|docs[.]cntd[.]ru', '', 'g'), '([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])', '\1\2', 'g'), '\n{3,}', concat(chr(10), chr(10)), 'g'), '[ \t]+', ' ', 'g')".replace("@", text))


_PART = "round((o_totalprice * 100 % {0}) / {0}, 3)"
_MEASURED = f"""o AS (SELECT *, round(1.0::DOUBLE * cr + 1.2::DOUBLE * faith + 1.1::DOUBLE * ar, 6) AS score FROM (SELECT o_orderkey AS trial, {_PART.format(977)} AS cr, CASE WHEN o_orderkey % 50 > 0 THEN {_PART.format(911)} END AS faith, {_PART.format(853)} AS ar, (o_custkey % 6 + 1)::INTEGER AS final_k, {_PART.format(100)} AS alpha, o_orderpriority AS model FROM orders))"""
#: Answers to the benchmark's items from the five best of twenty reranked candidates.
_ASKED = f"""{_LISTS.format(score=_RRF)},
nq AS (SELECT qid, count(*) AS n FROM qw GROUP BY qid),
sc AS (SELECT fu.qid, fu.doc_id, fused_rank, round(coalesce((SELECT count(*) FROM qw JOIN dw USING (w) WHERE qw.qid = fu.qid AND dw.doc_id = fu.doc_id), 0)::DOUBLE / n, 6) AS rr_score FROM fu JOIN nq ON nq.qid = fu.qid WHERE fused_rank <= 20),
fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rr_score DESC, fused_rank) AS rr_rank FROM sc) WHERE rr_rank <= 5 AND rr_score > 0.3),
li AS (SELECT fin.qid, concat('- T ', source, '— ', source, ' (п. ', lang, ')') AS line, min(rr_rank) AS first FROM fin JOIN documents USING (doc_id) GROUP BY ALL),
gl AS (SELECT qid, string_agg(line, chr(10) ORDER BY first) AS lines, count(*) AS sources FROM li GROUP BY qid),
gd AS (SELECT fin.qid, count(*) AS docs, string_agg(text, '|' ORDER BY rr_rank) AS contexts, string_agg(printf('%.4f', round(rr_score, 4)), ',' ORDER BY rr_rank) AS top FROM fin JOIN documents USING (doc_id) GROUP BY fin.qid),
ga AS (SELECT gd.*, sources, concat('Ответ: ', trim(regexp_extract(trim(text), '^[^\\n]*')), chr(10), chr(10), 'Источники:', chr(10), lines) AS answer FROM gd JOIN gl USING (qid) JOIN benchmark ON item_id = gd.qid),
nb AS (SELECT qid, count(*) AS bm FROM bm WHERE rank <= 30 GROUP BY qid), nv AS (SELECT qid, count(*) AS vec FROM ov WHERE rank <= 30 GROUP BY qid)"""

ORACLES = {
    "bm25_topk": f"WITH {_BM25} SELECT qid, doc_id, score, rank FROM bm WHERE rank <= 50",
    "bm25_index_stats": f"WITH {_BM25} SELECT n AS n_docs, round(avgdl, 6) AS avgdl, round(mean, 6) AS mean_idf, (SELECT count(*) FROM f) AS n_terms, (SELECT sum(df)::BIGINT FROM f) AS n_postings, (SELECT max(df) FROM f) AS max_df FROM c, m",
    "vector_topk": f"WITH {_VECTORS} SELECT qid, vec_id, distance, rank FROM t WHERE rank <= 20",
    "vector_mean_similarity": f"""WITH {_VECTORS}, x AS (SELECT label, i, sum(v[i] / len) AS s, count(*) AS n FROM u, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i)
SELECT label, round(sum(s * s) / (max(n) * max(n)), 6) AS mean_cosine, max(n) AS n FROM x GROUP BY label""",
    "rrf_fusion": f"WITH {_LISTS.format(score=_RRF)} SELECT qid, doc_id, fused, fused_rank FROM fu",
    "weighted_fusion": f"WITH {_LISTS.format(score='round(0.4::DOUBLE / coalesce(v, 1000) + 0.6::DOUBLE / coalesce(b, 1000), 6)')} SELECT qid, doc_id, fused, fused_rank FROM fu",
    "hybrid_fixed": _HYBRID.format(test="> 0.3"),
    "hybrid_adaptive": _HYBRID.format(test=">= 0.5"),
    "exact_code_route": """WITH dc AS (SELECT p_partkey AS doc_id, printf('%02d-%02d-%03d-%02d', p_size % 100, p_partkey % 7, p_partkey % 11, p_partkey % 3) AS code FROM part),
h AS (SELECT a.doc_id AS qid, b.doc_id, 'exact' AS route, 0 AS priority, b.doc_id AS pos FROM dc a JOIN dc b ON a.code = b.code WHERE a.doc_id % 100 = 0),
n AS (SELECT qid, count(*) AS n FROM h GROUP BY qid),
f AS (SELECT p_partkey AS qid, p_partkey + k AS doc_id, k AS rank FROM part, (SELECT unnest(range(1, 6)) AS k) WHERE p_partkey % 50 = 0),
g AS (SELECT f.qid, f.doc_id, 'hybrid' AS route, 1 AS priority, rank AS pos FROM f LEFT JOIN n ON n.qid = f.qid WHERE n IS NULL OR (n < 5 AND rank <= 2)),
x AS (SELECT *, row_number() OVER (PARTITION BY qid, doc_id ORDER BY priority, pos) AS rn FROM (SELECT * FROM h UNION ALL SELECT * FROM g)),
y AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY priority, pos, doc_id) AS rank FROM x WHERE rn = 1)
SELECT qid, doc_id, route, rank FROM y WHERE rank <= 5""",
    "dedup_first_wins": "SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY md5(text)",
    "dedup_two_level": f"""WITH p AS (SELECT page_id, {_URL.format('url')} AS url, md5(html) AS digest FROM pages),
a AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM p), b AS (SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id) AS k FROM a WHERE n = 1)
SELECT page_id, url, digest FROM b WHERE k = 1""",
    "doc_signature": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat('txt:', substr(text, 1, 220)) ELSE concat('cid:c', doc_id) END AS sig FROM documents",
    "normalize_metadata": "SELECT concat('c', doc_id) AS chunk_id, length(text)::INTEGER AS text_length, lang AS doc_type, CASE WHEN doc_id % 2 = 0 THEN source END AS source, source AS title, NULL::VARCHAR AS clause, trunc(n_chars / 100)::INTEGER AS page_start, NULL::INTEGER AS page_end FROM documents",
    "title_truncate": "SELECT doc_id, CASE WHEN length(text) > 200 THEN concat(substr(text, 1, 200), '…') ELSE text END AS title FROM documents",
    "clean_text_a": r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(concat(' ', chr(160), replace(text, '. ', concat('.', chr(160), ' ', repeat(chr(10), 4), ' ')), chr(9), chr(10)), chr(160), ' '), '^\s+|\s+$', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', concat(chr(10), chr(10)), 'g'), '[ \t]+\n', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS clean FROM documents""",
    "quality_metrics": r"""SELECT doc_id, n::INTEGER AS len, CASE WHEN n = 0 THEN 0 ELSE round(l / n::DOUBLE, 4) END AS letter_ratio, CASE WHEN n = 0 THEN 0 ELSE round(g / n::DOUBLE, 4) END AS digit_ratio, CASE WHEN n = 0 THEN true ELSE l / n::DOUBLE < 0.3 AND g / n::DOUBLE > 0.3 END AS noisy
FROM (SELECT doc_id, length(text) AS n, length(regexp_replace(text, '[^A-Za-z\x{0400}-\x{04FF}]', '', 'g')) AS l, length(regexp_replace(text, '[^0-9]', '', 'g')) AS g FROM documents)""",
    "page_marks": "SELECT doc_id, least(3, doc_id % 9)::INTEGER AS low, greatest(3, doc_id % 9)::INTEGER AS high, (length(text) + 2)::INTEGER AS left_chars FROM documents",
    "url_qa_id": f"""WITH s AS (SELECT page_id, {_SEGMENTS.format('url')} AS s FROM pages) SELECT page_id, concat(page_id % 13, '_', page_id) AS qa_id, CASE WHEN len(s) >= 4 AND s[-3] = 'questions' THEN concat(s[-2], '_', s[-1]) END AS own_id FROM s""",
    "url_slug": f"SELECT page_id, {_SEGMENTS.format('url')}[-1] AS slug FROM pages",
    "normalize_url": rf"""WITH p AS (SELECT page_id, url, concat(regexp_replace(url, '([a-z])/', '\1//', 'g'), '.html/#top') AS made FROM pages) SELECT page_id, {_URL.format('url')} AS url, {_URL.format('made')} AS made FROM p""",
    "pages_title_h1": r"""SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title, len(list_distinct(regexp_extract_all(html, 'href=["'']([^"''#\s]+)', 1))) AS n_links, coalesce(list_max(list_transform(regexp_extract_all(html, 'PAGEN_1=(\d+)', 1), lambda x: x::INTEGER)), 1)::INTEGER AS last_page FROM pages""",
    "qa_pairs": _PAIRS.format(15, 30),
    "context_pack": f"""WITH r AS (SELECT source AS qid, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank, {_STRIP.format('text')} AS block FROM documents),
{_PACK} SELECT qid, length(c)::INTEGER AS chars, md5(c) AS digest, n::INTEGER AS blocks FROM j""",
    "source_collect": """WITH r AS (SELECT lang AS qid, source, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank FROM documents), m AS (SELECT qid, source, min(rank) AS rank FROM r GROUP BY qid, source),
o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS source_rank FROM m) SELECT qid, source, rank, source_rank FROM o WHERE source_rank <= 25""",
    "clause_reassembly": """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents), x AS (SELECT doc_id AS doc, unnest(range(len(s))) AS line, unnest(s) AS text FROM l)
SELECT doc, (line % 2)::INTEGER AS clause, md5(string_agg(text, concat(chr(10), chr(10)) ORDER BY line)) AS digest, min(line)::INTEGER AS page_start, (max(line) + 1)::INTEGER AS page_end, min(line)::INTEGER AS first_line, count(*) AS orig_parts FROM x GROUP BY doc, line % 2""",
    "merge_union": """SELECT * FROM (SELECT concat('d', doc_id) AS chunk_id, length(text)::INTEGER AS chars, source, 0 AS source_ord FROM documents
UNION ALL SELECT concat('t', conv_id, '_', turn), length(text)::INTEGER, NULL, 1 FROM conversations UNION ALL SELECT concat('p', p_partkey), length(p_name)::INTEGER, p_brand, 2 FROM part UNION ALL SELECT concat('w', page_id), length(html)::INTEGER, url, 3 FROM pages) WHERE chars >= 5""",
    "hard_negatives_bm25": f"""WITH {_BM25}, g AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS neg_rank FROM bm WHERE rank > 10 AND rank <= 150 AND rank <> 12) SELECT qid, doc_id, rank, neg_rank FROM g WHERE neg_rank <= 7""",
    "hard_negatives_dense": f"""WITH {_VECTORS}, g AS (SELECT qid, vec_id, round(1 - distance, 6) AS similarity, rank FROM t WHERE rank > 10 AND rank <= 150),
h AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rank) AS neg_rank FROM g WHERE similarity <= 0.8) SELECT qid, vec_id, similarity, rank, neg_rank FROM h WHERE neg_rank <= 7""",
    "pair_merge_dedup": f"""WITH p AS ({_PAIRS.format(1, 1)}), x AS (SELECT md5(question) AS query, md5(answer) AS document, 1 AS label FROM p UNION ALL SELECT md5(question), md5(CASE WHEN conv_id % 2 = 0 THEN answer ELSE question END), 0 FROM p)
SELECT query, document, max(label)::INTEGER AS label FROM x GROUP BY query, document""",
    "ndcg_at_10": f"""WITH {_VECTORS}, g AS (SELECT t.qid, round(1 - distance, 1) AS score, CASE WHEN a.label = b.label THEN 1 ELSE 0 END AS rel FROM t JOIN e a ON a.vec_id = t.vec_id JOIN e b ON b.vec_id = t.qid WHERE rank <= 30),
o AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC) AS pos, row_number() OVER (PARTITION BY qid ORDER BY rel DESC) AS ideal FROM g),
s AS (SELECT *, avg(CASE WHEN pos <= 10 THEN 1 / log2(pos + 1) ELSE 0 END) OVER (PARTITION BY qid, score) AS share FROM o)
SELECT qid, round(CASE WHEN sum(CASE WHEN ideal <= 10 THEN rel / log2(ideal + 1) ELSE 0 END) > 0 THEN sum(rel * share) / sum(CASE WHEN ideal <= 10 THEN rel / log2(ideal + 1) ELSE 0 END) ELSE 0 END, 6) AS ndcg FROM s GROUP BY qid HAVING count(*) >= 2""",
    "generation_stats": "SELECT floor(o_orderkey / 28.0)::BIGINT AS generation, max(s) AS best_score, round(avg(s), 6) AS mean_score, min(s) AS worst_score, round(stddev_pop(s), 6) AS std_score FROM (SELECT o_orderkey, round(o_totalprice, 2) AS s FROM orders) GROUP BY 1",
    "pareto_front": """WITH r AS (SELECT l_suppkey, round(sum(l_quantity), 2) AS m1, round(avg(l_discount), 6) AS m2, round(avg(l_tax), 6) AS m3 FROM lineitem GROUP BY l_suppkey)
SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM r o WHERE o.m1 >= r.m1 AND o.m2 >= r.m2 AND o.m3 >= r.m3 AND (o.m1 > r.m1 OR o.m2 > r.m2 OR o.m3 > r.m3))""",
    "weighted_best": "SELECT o_orderkey AS trial, round(1.0::DOUBLE * s + 1.2::DOUBLE * (s / 2) + 1.1::DOUBLE, 4) AS w_score FROM (SELECT o_orderkey, round(o_totalprice, 2) AS s FROM orders) ORDER BY w_score DESC, trial LIMIT 1",
    "iqr_filter": """WITH o AS (SELECT o_orderpriority, round(o_totalprice, 2) AS s FROM orders), q AS (SELECT o_orderpriority, quantile_cont(s, 0.25) AS a, quantile_cont(s, 0.75) AS b FROM o GROUP BY 1)
SELECT o_orderpriority, count(*) AS n, min(s) AS low, max(s) AS high FROM o JOIN q USING (o_orderpriority) WHERE s >= a - 1.5 * (b - a) AND s <= b + 1.5 * (b - a) GROUP BY 1""",
    "metric_correlation": "SELECT a, b, r FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") for b in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + ")",
    "latency_p95": "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value, round(quantile_cont(value, 0.95), 6) AS p95_value FROM events GROUP BY 1",
    "incremental_upsert": "SELECT doc_id, length(text)::INTEGER AS chars, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'old' END AS source FROM documents WHERE doc_id % 2 = 0 OR doc_id % 3 <> 0",
    "norm_text_assembly": """WITH r AS (SELECT l_partkey, string_agg(concat(l_suppkey, ' ', s_name, ' — ', l_quantity::INTEGER), '; ' ORDER BY l_orderkey, l_linenumber, l_suppkey::VARCHAR, s_name, l_quantity::INTEGER::VARCHAR) AS res FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
b AS (SELECT p_partkey, array_to_string([concat('НОРМАТИВ: P', p_partkey, ' ', trim(concat(p_name, ' ', p_type))), concat('Единица измерения: ', p_brand), concat('Сборник: B | Таблица ', p_size, ' T'), '', 'СОДЕРЖАНИЕ РАБОТЫ:',
  CASE WHEN p_size % 3 > 0 THEN concat(p_brand, chr(10), p_type, chr(10), p_brand) ELSE 'Не указано' END, '', 'РЕСУРСЫ:', coalesce(res, 'Не указано'), '', 'НОРМАТИВНЫЕ ССЫЛКИ:',
  CASE WHEN p_size % 2 = 0 THEN concat('Норма: ', p_size, ', Спецификация: | Норма: , Спецификация: ', p_brand) ELSE 'Не указано' END], chr(10)) AS t FROM part LEFT JOIN r ON p_partkey = l_partkey)
SELECT p_partkey, length(t)::INTEGER AS chars, md5(t) AS digest FROM b""",
    "sentence_chunks": f"SELECT doc_id, part::INTEGER AS part, chunk FROM (SELECT doc_id, unnest(c) AS chunk, unnest(range(len(c))) AS part FROM (SELECT doc_id, {_FORCED.format(t='text', most=1500)} AS c FROM documents WHERE text <> ''))",
    "clause_chunks": f"""WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents),
s AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM l),
m AS (SELECT *, coalesce(NOT regexp_matches(lag(line) OVER (PARTITION BY doc_id ORDER BY i), '\\p{{L}}$'), true) AS begins FROM s),
g AS (SELECT *, sum(begins::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM m),
b AS (SELECT doc_id, min(i) AS n, trim(substr(arg_min(line, i), 1)) AS first, string_agg(concat(i, '. ', line), chr(10) ORDER BY i) AS t FROM g GROUP BY doc_id, g),
c AS (SELECT doc_id, n, substr({_STRIP.format('first')}, 1, 150) AS title, {_STRIP.format("regexp_replace(regexp_replace(t, '([\\p{L}\\p{N}_])-\\s*\\n\\s*([\\p{L}\\p{N}_])', '\\1\\2', 'g'), '[ \\t]+', ' ', 'g')")} AS t FROM b),
f AS (SELECT doc_id, n, title, {_FORCED.format(t='t', most=1500)} AS f FROM c WHERE length(t) >= 50),
j AS (SELECT doc_id, n, title, {_MERGED.format(parts='f', most=1500)} AS f FROM f)
SELECT concat(doc_id, '__', n, CASE WHEN len(f) > 1 THEN concat('.', k) ELSE '' END) AS chunk_id, doc_id::VARCHAR AS doc_id, n::VARCHAR AS clause, NULL::VARCHAR AS subclause, title, 1 AS level, NULL::VARCHAR AS parent_id, false AS has_children, 0 AS page_start, 0 AS page_end, text
FROM (SELECT *, unnest(f) AS text, unnest(range(1, len(f) + 1)) AS k FROM j) WHERE length(text) >= 50""",
    "html_qa": rf"""WITH p AS (SELECT page_id, url, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)>.*?</(script|style)>', '', 'g') AS h FROM pages),
a AS (SELECT page_id, url, regexp_extract(h, '(?s)<article>(.*?)</article>', 1) AS body, regexp_extract(h, '(?s)<h1>(.*?)</h1>', 1) AS head FROM p),
n AS (SELECT page_id, url, {_ENTITIES.format("regexp_replace(head, '<[^>]*>', ' ', 'g')")} AS q, list_filter(list_transform(string_split_regex(body, '<[^>]*>'), lambda x: {_STRIP.format(_ENTITIES.format('x'))}), lambda x: x <> '') AS parts FROM a),
t AS (SELECT page_id, url, {_TIDY.format('q')} AS question, {_TIDY.format('array_to_string(parts, chr(10))')} AS answer FROM n),
r AS (SELECT page_id, url, question, CASE WHEN question <> '' AND starts_with(lower(answer), lower(question)) THEN {_TIDY.format('substr(answer, length(question) + 1)')} ELSE answer END AS answer FROM t)
SELECT * FROM r WHERE length(question) >= 5 AND length(answer) >= 10""",
    "random_negatives": """WITH c AS (SELECT doc_id, row_number() OVER (ORDER BY substr(md5(doc_id::VARCHAR), 1, 3), md5(doc_id::VARCHAR), doc_id) - 1 AS number FROM documents),
z AS (SELECT count(*) AS n FROM c), p AS (SELECT item_id AS qid, item_id AS positive, ('0x' || substr(md5(concat('42|', item_id, '|', item_id)), 1, 12))::BIGINT AS start FROM benchmark),
d AS (SELECT qid, positive, draw, (start + draw) % n AS number FROM p, z, (SELECT unnest(range(4)) AS draw) WHERE draw < n),
f AS (SELECT qid, positive, c.doc_id, row_number() OVER (PARTITION BY qid, positive ORDER BY draw) AS neg_rank FROM d JOIN c USING (number) WHERE c.doc_id <> qid) SELECT qid, positive, doc_id, neg_rank::INTEGER AS neg_rank FROM f WHERE neg_rank <= 3""",
    "clean_page_b": rf"""WITH r AS (SELECT doc_id, concat('Страница 3 из 9', chr(13), chr(10), replace(text, '. ', concat(' (в редакции 2020) -', repeat(chr(10), 4))), chr(10), '©бщая  docs.cntd.ru часть-', chr(10), ' ная', chr(10), ' ', chr(10), 'fgiscs.minstroyrf.ru x', chr(10), 'end') AS t FROM documents),
a AS (SELECT doc_id, {_page('t')} AS page, {_page("regexp_replace(t, '\s*[(]в редакции 2020[)]\s*', '', 'g')")} AS edited,
  trim(array_to_string(list_filter(string_split(replace(t, chr(13), ''), chr(10)), lambda x: trim(x) <> '' AND NOT contains(x, 'fgiscs.minstroyrf.ru')), chr(10))) AS unstamped FROM r)
SELECT doc_id, md5(page) AS page, md5(edited) AS edited, md5(unstamped) AS unstamped FROM a""",
    "official_documents": """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), x AS (SELECT doc_id, unnest(l) AS text, unnest(range(1, len(l) + 1)) AS page FROM l),
g AS (SELECT doc_id, trim(string_agg(concat('<<<PAGE:', page, '>>>', chr(10), text, chr(10)), chr(10) ORDER BY page) FILTER (text <> ''), chr(10) || ' ') AS t, CASE WHEN count(*) >= 5 THEN 'mixed' ELSE 'text' END AS extraction, trim(arg_min(text, page)) AS first, substr(arg_min(text, page), 1, 1000) AS head FROM x GROUP BY doc_id)
SELECT concat('doc_', doc_id, '-a') AS doc_id, concat('doc_', doc_id, '-a.pdf') AS source, CASE WHEN length(trim(head)) > 20 AND length(trim(head)) < 200 THEN substr(trim(head), 1, 180) ELSE concat('doc ', doc_id, ' a') END AS title, extraction, md5(t) AS digest FROM g WHERE t IS NOT NULL""",
    "qa_merge": f"""WITH p AS ({_PAIRS.format(1, 1)}), r AS (SELECT conv_id, turn, conv_id * 100 + turn AS line, {_TIDY.format('substr(question, 1, 300)')} AS q, {_TIDY.format('substr(answer, 1, 300)')} AS a, CASE WHEN conv_id % 3 = 0 THEN concat('https://x.org/a/questions/', turn, '/', conv_id) ELSE '' END AS url FROM p WHERE conv_id % 7 > 0),
c AS (SELECT *, concat('Вопрос: ', q, chr(10), chr(10), 'Ответ: ', a) AS t, CASE WHEN url = '' THEN line::VARCHAR ELSE concat(turn, '_', conv_id) END AS qa_id FROM r WHERE q <> '' AND a <> '')
SELECT concat('qa_site_', qa_id, '_1') AS chunk_id, t AS text, url AS source, CASE WHEN length(q) > 200 THEN concat(substr(q, 1, 200), '…') ELSE q END AS title, qa_id, line AS line_num, 1 AS part_number, 1 AS total_parts FROM c WHERE length(t) >= 100""",
    "qa_counts": f"SELECT role AS file, count(*) AS total, count(*) FILTER (turn % 4 <> 3 AND role <> 'user' AND {_TIDY.format('text')} <> '') AS usable, count(*) FILTER (NOT (turn % 4 <> 3 AND role <> 'user' AND {_TIDY.format('text')} <> '')) AS skipped FROM conversations GROUP BY role",
    "unseen_urls": f"WITH p AS (SELECT page_id, {_URL.format('url')} AS url FROM pages) SELECT page_id, url FROM p WHERE url NOT IN (SELECT url FROM p WHERE page_id % 3 = 0)",
    "training_pairs": f"""WITH p AS ({_PAIRS.format(1, 1)}), r AS (SELECT conv_id % 2 AS f, turn % 2 = 0 AS joined, question AS q, answer AS a FROM p),
k AS (SELECT f, CASE WHEN joined THEN trim(concat(q, ' ')) ELSE q END AS q, CASE WHEN joined THEN trim(a) ELSE a END AS a FROM r), u AS (SELECT f, trim(q) AS q, trim(a) AS a FROM k WHERE length(q) >= 15 AND length(a) >= 30),
b AS (SELECT q, a, row_number() OVER (ORDER BY md5(concat('42|', q, '|', a))) AS n FROM u WHERE f = 1)
SELECT DISTINCT md5(q) AS question, md5(a) AS answer FROM (SELECT q, a FROM u WHERE f = 0 UNION ALL SELECT q, a FROM b WHERE n <= (SELECT greatest(1, floor(count(*) * 0.15)) FROM b))""",
    "training_split": f"""WITH p AS (SELECT DISTINCT md5(question) AS q, md5(answer) AS a FROM ({_PAIRS.format(1, 1)})), n AS (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', q, '|', a)), q, a) AS n, count(*) OVER () AS m FROM p) SELECT q, a, n <= floor(m * 0.9::DOUBLE) AS is_train FROM n""",
    "synthetic_negatives": f"""WITH p AS (SELECT DISTINCT question AS q, answer AS a FROM ({_PAIRS.format(1, 1)})), n AS (SELECT *, row_number() OVER (ORDER BY md5(concat('42|', q, '|', a)), q, a) AS n, count(*) OVER () AS m FROM p),
c AS (SELECT q, a FROM n WHERE n <= floor(m * 0.25) AND length(a) % 7 > 0),
l AS (SELECT q, list_filter(list_transform(string_split(concat(reverse(a), chr(10), ' ', chr(10), q, chr(10), reverse(q), ' ', reverse(a)), chr(10)), lambda x: trim(x)), lambda x: length(x) > 60)[1:2] AS l FROM c)
SELECT md5(q) AS query, md5(unnest(l)) AS document, 0 AS label FROM l""",
    "label_counts": """WITH p AS (SELECT source, doc_id, toxic FROM labels JOIN documents USING (doc_id)) SELECT source AS query, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id, toxic) AS documents, string_agg(toxic::VARCHAR, ',' ORDER BY doc_id, toxic) AS labels, (SELECT count(*) FROM p WHERE toxic = 1) AS positives, (SELECT count(*) FROM p WHERE toxic <> 1) AS negatives FROM p GROUP BY source""",
    "ask_answers": f"""WITH {_ASKED}
SELECT q.item_id AS qid, CASE WHEN docs IS NULL THEN 'Ответ: нет данных в контексте: база не нашла подходящие фрагменты. Уточните запрос.' ELSE answer END AS answer, coalesce(docs, 0)::INTEGER AS docs_count, coalesce(sources, 0)::INTEGER AS n_sources, md5(coalesce(contexts, '')) AS contexts, 'hybrid' AS mode, coalesce(bm, 0)::INTEGER AS bm25, coalesce(vec, 0)::INTEGER AS vec, coalesce(top, '') AS top_scores
FROM benchmark q LEFT JOIN ga ON ga.qid = q.item_id LEFT JOIN nb ON nb.qid = q.item_id LEFT JOIN nv ON nv.qid = q.item_id""",
    "rag_triad": f"""WITH {_ASKED},
said AS (SELECT q.item_id AS qid, q.text AS q, CASE WHEN docs IS NULL THEN 'Ответ: нет данных в контексте: база не нашла подходящие фрагменты. Уточните запрос.' ELSE answer END AS a, CASE WHEN q.item_id % 2 = 0 THEN concat(q.text, ' ', q.text) ELSE 'нет данных' END AS ref FROM benchmark q LEFT JOIN ga ON ga.qid = q.item_id),
tx AS (SELECT 'q' AS kind, qid, 0 AS pos, q AS t FROM said UNION ALL SELECT 'a', qid, 0, a FROM said UNION ALL SELECT 'r', qid, 0, ref FROM said UNION ALL SELECT 'd', fin.qid, fin.rr_rank, text FROM fin JOIN documents USING (doc_id)),
wd AS (SELECT kind, qid, pos, md5(unnest({_TOKENS.format('lower(t)')})) AS h FROM tx),
vc AS (SELECT kind, qid, pos, (16 * (strpos('0123456789abcdef', h[1]) - 1) + strpos('0123456789abcdef', h[2]) - 1) % 64 AS place, count(*)::DOUBLE AS x FROM wd GROUP BY ALL),
ln AS (SELECT kind, qid, pos, sqrt(sum(x * x)) AS len FROM vc GROUP BY ALL),
cs AS (SELECT a.kind AS ka, b.kind AS kb, a.qid, b.pos, sum(a.x * b.x) AS dot FROM vc a JOIN vc b ON a.qid = b.qid AND a.place = b.place WHERE a.kind IN ('q', 'a') AND b.kind IN ('d', 'r') GROUP BY ALL),
co AS (SELECT ka, kb, cs.qid, cs.pos, dot / (l.len * m.len) AS c FROM cs JOIN ln l ON l.kind = ka AND l.qid = cs.qid JOIN ln m ON m.kind = kb AND m.qid = cs.qid AND m.pos = cs.pos)
SELECT said.qid, round(coalesce((SELECT sum(c) / docs FROM co WHERE ka = 'q' AND kb = 'd' AND co.qid = said.qid), 0), 6) AS context_relevance, round(coalesce((SELECT sum(c) / least(docs, 3) FROM co WHERE ka = 'a' AND kb = 'd' AND pos <= 3 AND co.qid = said.qid), 0), 6) AS faithfulness,
round(coalesce((SELECT sum(c) FROM co WHERE ka = 'a' AND kb = 'r' AND co.qid = said.qid), 0), 6) AS answer_relevance FROM said LEFT JOIN ga ON ga.qid = said.qid""",
    "trial_metrics": f"""WITH {_LISTS.format(score=_RRF)}, nq AS (SELECT qid, count(*) AS n FROM qw GROUP BY qid),
cv AS (SELECT cand.qid, cand.doc_id, b, v, round(coalesce((SELECT count(*) FROM qw JOIN dw USING (w) WHERE qw.qid = cand.qid AND dw.doc_id = cand.doc_id), 0)::DOUBLE / n, 6) AS rr FROM cand JOIN nq USING (qid)),
tr(trial, bk, vk, rk, rr_k, thr, fk, kind, alpha, mode, ad) AS (VALUES (1, 30, 30, 60, 20, 0.3, 5, 'rrf', 0.5, 'fixed', 0.05), (2, 10, 30, 20, 10, 0.5, 3, 'weighted', 0.4, 'fixed', 0.05), (3, 30, 5, 60, 25, 0.0, 8, 'rrf', 0.5, 'adaptive', 0.6), (4, 20, 20, 60, 40, 0.0, 4, 'weighted', 0.9, 'adaptive', 0.4)),
ta AS (SELECT tr.*, qid, doc_id, rr, CASE WHEN b <= bk THEN b END AS b, CASE WHEN v <= vk THEN v END AS v FROM cv, tr),
tf AS (SELECT *, row_number() OVER (PARTITION BY trial, qid ORDER BY fused DESC, b NULLS LAST, v NULLS LAST, doc_id) AS place FROM (SELECT *, round(CASE WHEN kind = 'weighted' THEN alpha::DOUBLE / coalesce(v, 1000) + (1 - alpha::DOUBLE) / coalesce(b, 1000) ELSE coalesce(1.0::DOUBLE / (rk + b), 0) + coalesce(1.0::DOUBLE / (rk + v), 0) END, 6) AS fused FROM ta WHERE b IS NOT NULL OR v IS NOT NULL)),
to_ AS (SELECT *, row_number() OVER (PARTITION BY trial, qid ORDER BY rr DESC, place) AS rank FROM tf WHERE place <= least(bk + vk, rr_k)),
ts AS (SELECT trial, qid, avg(rr * rr) AS cr, count(*) AS docs FROM to_ WHERE rank <= fk AND CASE WHEN mode = 'adaptive' THEN rr >= ad ELSE rr > thr END GROUP BY trial, qid)
SELECT tr.trial::BIGINT AS trial, round(avg(coalesce(cr, 0)), 6) AS context_relevance, sum(coalesce(docs, 0))::BIGINT AS docs FROM tr CROSS JOIN benchmark LEFT JOIN ts ON ts.trial = tr.trial AND ts.qid = item_id GROUP BY tr.trial""",
    "leading_scores": "SELECT source AS qid, doc_id, n_chars FROM (SELECT *, sum((n_chars < 300)::INTEGER) OVER (PARTITION BY source ORDER BY doc_id) AS bad FROM documents) WHERE bad = 0",
    "embedding_fill": "WITH t AS (SELECT substr(text, 1, 60) AS t, bool_or(doc_id % 3 = 0) AS stored FROM documents GROUP BY 1) SELECT md5(t) AS text, stored::INTEGER::DOUBLE AS stored, length(t)::DOUBLE AS size FROM t",
    "metadata_values": """SELECT event_id, concat('["', event_type, '",null]') AS listed, value AS number, strftime(ts, '%Y-%m-%d') AS day FROM events""",
    "parent_texts": "WITH p AS (SELECT doc_id AS chunk_id, CASE WHEN doc_id % 5 > 0 THEN doc_id // 2 END AS parent_id, md5(text) AS text FROM documents) SELECT a.parent_id, a.chunk_id, a.text, b.text AS parent_text FROM p a LEFT JOIN p b ON b.chunk_id = a.parent_id",
    "answer_finish": rf"""WITH r AS (SELECT conv_id, turn, role, {_STRIP.format("concat('источники ', chr(10), 'x', chr(10), chr(10), chr(10), chr(10), 'Вопрос: a b', chr(10), text)")} AS t FROM conversations),
d AS (SELECT *, {_STRIP.format(r"regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '(?im)^\s*Вопрос\s*:\s*[^\n]*$', '', 'g')")} AS b FROM r),
l AS (SELECT *, [concat('- ', CASE WHEN turn % 2 = k THEN '[01-02] ' ELSE '' END, role, CASE WHEN turn % 3 > 0 THEN concat('— f.pdf (', CASE WHEN turn % 4 > k THEN 'п. 3.1, ' ELSE '' END, 'стр. ', turn, ')') ELSE concat(' (', CASE WHEN turn % 4 > k THEN 'п. 3.1, ' ELSE '' END, 'стр. ', turn, ')') END) FOR k IN [0, 1]] AS lines FROM d)
SELECT conv_id, turn, md5(concat('Ответ: ', b, chr(10), chr(10), 'Источники:', chr(10), CASE WHEN lines[1] = lines[2] THEN lines[1] ELSE concat(lines[1], chr(10), lines[2]) END)) AS answer FROM l""",
    "generation_metrics": f"""WITH {_MEASURED}, w AS (SELECT floor(trial / 28.0)::BIGINT + 1 AS generation, cr, faith, ar FROM o WHERE faith IS NOT NULL), x AS (SELECT generation, 'cr' AS metric, cr AS x FROM w UNION ALL SELECT generation, 'faith', faith FROM w UNION ALL SELECT generation, 'ar', ar FROM w)
SELECT generation, metric, round(avg(x), 6) AS mean_value, round(stddev_pop(x), 6) AS std_value, max(x) AS best_value FROM x GROUP BY generation, metric""",
    "final_k_boxes": f"WITH {_MEASURED} SELECT final_k, count(*) AS n, min(score) AS low, max(score) AS high, round(quantile_cont(score, 0.25), 6) AS q1, round(quantile_cont(score, 0.5), 6) AS median, round(quantile_cont(score, 0.75), 6) AS q3 FROM o WHERE score IS NOT NULL GROUP BY final_k",
    "model_medians": f"""WITH {_MEASURED}, q AS (SELECT model, quantile_cont(score, 0.25) AS a, quantile_cont(score, 0.75) AS b FROM o WHERE score IS NOT NULL GROUP BY model), k AS (SELECT model, score FROM o JOIN q USING (model) WHERE score >= a - 1.5 * (b - a) AND score <= b + 1.5 * (b - a)),
m AS (SELECT model, count(*) AS n, min(score) AS low, max(score) AS high, round(quantile_cont(score, 0.25), 6) AS q1, round(quantile_cont(score, 0.5), 6) AS median, round(quantile_cont(score, 0.75), 6) AS q3 FROM k GROUP BY model) SELECT *, row_number() OVER (ORDER BY median DESC, model)::INTEGER AS place FROM m""",
    "search_convergence": f"WITH {_MEASURED}, g AS (SELECT floor(trial / 280.0)::BIGINT AS generation, max(score) AS best_score FROM o WHERE score IS NOT NULL GROUP BY 1), b AS (SELECT *, max(best_score) OVER (ORDER BY generation ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g) SELECT generation, best_score, greatest(best_score, coalesce(before, best_score)) AS best_so_far, before IS NULL OR best_score > before AS raised FROM b",
    "trial_history": f"""WITH {_MEASURED} SELECT trial, floor(trial / 28.0)::BIGINT + 1 AS gen, printf('%.4f', cr) AS "CR", printf('%.4f', faith) AS "Faith", printf('%.4f', ar) AS "AR", printf('%.4f', 1.0::DOUBLE * cr + 1.2::DOUBLE * faith + 1.1::DOUBLE * ar) AS w_score, 30 AS bm25_k, 20 AS vec_k, 60 AS rrf_k, 10 AS rerank_k, '0.0500' AS thresh, final_k AS fk, printf('%.2f', alpha) AS alpha, 'fixed' AS mode, '0.100' AS adapt_thresh FROM o WHERE faith IS NOT NULL""",
    "search_report": f"WITH {_MEASURED} SELECT count(*) AS n_trials, max(score) AS best_score, round(avg(score), 6) AS mean_score, 1.5::DOUBLE AS baseline_score, round((max(score) / 1.5::DOUBLE - 1) * 100, 4) AS gain_percent FROM o WHERE score IS NOT NULL",
}
