"""SQL (DuckDB) of the dealt operators that SQL can express within reason, written apart from the DataFrame plans."""

_BARE = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Canonical notices, and the SHA-256 of canonical whole texts.
_NOTICES = "('MIT', 'released under the mit license'), ('MIT', 'licensed under the mit license'), ('MIT', 'this project is licensed under the terms of the mit license'), ('MIT', 'spdx license identifier mit'), ('Apache-2.0', 'licensed under the apache license version 2 0'), ('Apache-2.0', 'licensed under the apache license version 2 0 the license'), ('Apache-2.0', 'spdx license identifier apache 2 0'), ('GPL-3.0', 'this work is licensed under the gnu general public license version 3'), ('GPL-3.0', 'spdx license identifier gpl 3 0 only'), ('GPL-2.0', 'this work is licensed under the gnu general public license version 2'), ('CC-BY-NC-4.0', 'licensed under cc by nc 4 0'), ('CC-BY-4.0', 'licensed under cc by 4 0'), ('CC-BY-SA-4.0', 'licensed under cc by sa 4 0'), ('BSD-3-Clause', 'spdx license identifier bsd 3 clause')"
_WHOLE = "('0BSD', '25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c'), ('Apache-2.0', '6ed31aab79be61ef3197a09ceec1934e9c9c99181c892d83a2af9d37096fbb4e'), ('Artistic-1.0', 'e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2'), ('BSD-2-Clause', '447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2'), ('BSD-2-Clause', 'a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30'), ('BSD-3-Clause', '9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2'), ('BSD-3-Clause', 'cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15'), ('BSD-3-Clause-UC', '21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651'), ('CC0-1.0', '93ec2fa12c2b8b785bf1693758b00bf17f3d28a193dc27ed5d672795dc2facd1'), ('GFDL-1.2', '5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71'), ('GFDL-1.3', '93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6'), ('GPL-1.0', '8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224'), ('GPL-2.0', 'efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821'), ('GPL-3.0', '586c3618658ef60aad1bc2ebb196d5ca77bda2718389a7bf943a62adc134b9fd'), ('ISC', '217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a'), ('ISC', 'f172f90a892d869d5d840d5f4363218a9b21bdb1bd3925ba9c752d1660134fee'), ('LGPL-2.0', '61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908'), ('LGPL-2.1', '4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891'), ('LGPL-3.0', 'aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be'), ('MIT', '0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c'), ('MIT', '35a446201226de6b27cfb7106d0f6c697f63bfeac2913dcf89024911e66ef164'), ('MIT', '6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127'), ('MPL-1.1', '9445742bef21726ee53c21c26a7dbc9d839dac2b3cfa02bdf10ef5f88ce29f89'), ('MPL-2.0', 'aa68eac73d9ffa524a89a43ee4c494b1a4993a2c8bbc6872f75af801dc59dffa')"
_HEAD = r"^[ \t\r/*#;>-]*((copyright|\(c\)|©).*|all rights reserved[.]?[ \t\r]*)?$"
_COPYRIGHT = r"^[ \t\r/*#;>-]*(copyright[ \t:]*(\(c\)|©|[\[<{(]?(yyyy|year|[0-9]{4})|by\b)|(\(c\)|©)[ \t]*(copyright|[0-9]{4}|by\b)|all rights reserved[.]?[ \t\r]*$)"


def _spelled(value: str) -> str:
    """Equivalent spellings, over words between single blanks."""
    out = f"concat(' ', {value}, ' ')"
    for old, new in (("licence", "license"), ("licencing", "licensing"), (" sub licens", " sublicens"), (" non infringement", " noninfringement"), (" non commercial", " noncommercial"), (" non exclusive", " nonexclusive"), (" non transferable", " nontransferable"), (" merchantibility ", " merchantability "), (" copyright owner", " copyright holder")):
        out = f"replace({out}, '{old}', '{new}')"
    return f"trim({out}, ' ')"


_LICENSES = rf"""WITH d AS (SELECT doc_id, string_split(lower(coalesce(text, '')), chr(10)) AS l FROM documents),
p AS (SELECT *, coalesce(list_position(list_transform(l, lambda x: regexp_matches(x, '[^\s]')), true), 1) AS first FROM d),
h AS (SELECT *, first + CASE WHEN regexp_matches(l[first], 'licen[sc]e') THEN 1 ELSE 0 END AS body FROM p),
e AS (SELECT *, body - 1 + coalesce(list_position(list_transform(l[body:], lambda x: regexp_matches(x, '{_HEAD}')), false), len(l) + 1) AS stop FROM h),
c AS (SELECT doc_id, list_filter(list_transform(list_filter(l, lambda x, i: NOT regexp_matches(x, '{_COPYRIGHT}') AND NOT (i >= body AND i < stop AND regexp_matches(x, '{_HEAD}'))),
  lambda x: array_to_string(regexp_extract_all(x, '[\p{{L}}\p{{N}}]+'), ' ')), lambda x: x <> '') AS l FROM e),
w AS (SELECT doc_id, sha256({_spelled("array_to_string(l, ' ')")}) AS digest FROM c),
n AS (SELECT doc_id, count(DISTINCT id) AS n, string_agg(DISTINCT id, ',' ORDER BY id) AS notices FROM (SELECT doc_id, {_spelled("unnest(l)")} AS line FROM c) JOIN (VALUES {_NOTICES}) AS k(id, line) USING (line) GROUP BY doc_id)
SELECT w.doc_id, k.id AS license_id, coalesce(n.n, 0) AS n_notices, coalesce(n.notices, '') AS notices FROM w LEFT JOIN (VALUES {_WHOLE}) AS k(id, digest) USING (digest) LEFT JOIN n ON n.doc_id = w.doc_id"""

#: kind, order, pattern, what takes the place of a match: the match itself between marks.
_KINDS = r"""VALUES ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+', '\0'), ('ip', 2, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)', '\0'), ('card', 3, '[0-9]([ -]?[0-9])+', '\0'), ('phone', 4, '\+[0-9][ ().0-9-]+[0-9]', '\0'),
('iban', 5, '\b(DE[0-9]{2}( ?[A-Z0-9]){18}|GB[0-9]{2}( ?[A-Z0-9]){18}|FR[0-9]{2}( ?[A-Z0-9]){23}|NL[0-9]{2}( ?[A-Z0-9]){14}|ES[0-9]{2}( ?[A-Z0-9]){20}|IT[0-9]{2}( ?[A-Z0-9]){23}|BE[0-9]{2}( ?[A-Z0-9]){12}|CH[0-9]{2}( ?[A-Z0-9]){17}|AT[0-9]{2}( ?[A-Z0-9]){16}|NO[0-9]{2}( ?[A-Z0-9]){11})\b', '\0'),
('ssn', 6, '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b', '\0'), ('secret', 7, '((?i:token|api[_-]?key|access[_-]?key|secret[_-]?key|secret|passwo?r?d|pwd)["'']? {0,2}[:=] {0,2}["'']?)([A-Za-z0-9_+/-]{16,})', '\2')"""
_LUHN = "list_sum(list_transform(range(len(digits)), lambda i: CASE WHEN i % 2 = 0 THEN digits[len(digits) - i]::INTEGER WHEN digits[len(digits) - i]::INTEGER > 4 THEN 2 * digits[len(digits) - i]::INTEGER - 9 ELSE 2 * digits[len(digits) - i]::INTEGER END)) % 10 = 0"
_MOD97 = "list_reduce(list_prepend(0::BIGINT, list_transform(range(len(bare)), lambda i: ascii(bare[(i + 4) % len(bare) + 1])::BIGINT)), lambda a, c: CASE WHEN c < 65 THEN a * 10 + c - 48 ELSE a * 100 + c - 55 END % 97) = 1"
_PERSONAL = rf"""WITH d AS (SELECT doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents), k(kind, place, pattern, shown) AS ({_KINDS}),
m AS (SELECT doc_id, kind, place, string_split(regexp_replace(t, pattern, concat(CASE shown WHEN '\2' THEN '\1' ELSE '' END, chr(1), shown, chr(1)), 'g'), chr(1)) AS p FROM d, k),
x AS (SELECT doc_id, kind, place, unnest(range(len(p))) AS i, unnest(p) AS piece FROM m),
y AS (SELECT *, coalesce(sum(length(piece)) OVER w, 0) AS a, lag(piece) OVER (PARTITION BY doc_id, kind ORDER BY i) AS before, regexp_replace(piece, '[^0-9]', '', 'g') AS digits, replace(piece, ' ', '') AS bare
  FROM x WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT doc_id, kind, place, a, concat_ws(':', kind, a::BIGINT, (a + length(piece))::BIGINT) AS span FROM y WHERE i % 2 = 1 AND CASE kind WHEN 'email' THEN true
  WHEN 'ip' THEN coalesce(list_max(list_transform(string_split(piece, '.'), lambda q: coalesce(try_cast(q AS HUGEINT), 256))) <= 255, false)
  WHEN 'card' THEN len(digits) BETWEEN 16 AND 19 AND {_LUHN} WHEN 'phone' THEN len(digits) BETWEEN 8 AND 15 WHEN 'iban' THEN {_MOD97}
  WHEN 'ssn' THEN NOT regexp_matches(piece, '^(000|666|9)|-00-|-0000$') AND regexp_matches(lower(right(before, 40)), '\b(ssn|social security|tax id)')
  ELSE regexp_matches(piece, '[0-9]') AND regexp_matches(piece, '[A-Za-z]') END),
g AS (SELECT doc_id, string_agg(span, ',' ORDER BY place, a) AS spans, string_agg(span, ',' ORDER BY place, a) FILTER (place <= 4) AS base, count(*) FILTER (kind = 'email') AS e, count(*) FILTER (kind = 'ip') AS i, count(*) FILTER (kind = 'card') AS c, count(*) FILTER (kind = 'phone') AS f FROM v GROUP BY doc_id)
SELECT d.doc_id, coalesce(e, 0) AS n_email, coalesce(i, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(f, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, spans IS NOT NULL AS personal FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""

_WORD = r"[0-9a-z\x{{80}}-\x{{10FFFF}}]+".replace("{{", "{").replace("}}", "}")
_CONTAMINATED = rf"""WITH d AS (SELECT doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS raw, {_LOWER} AS t FROM documents), dw AS (SELECT doc_id, regexp_extract_all(t, '{_WORD}') AS w FROM d),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS part, least(13, len(w)) AS n FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS k FROM b WHERE len(w) > 0)),
z AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS part FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM dw, z WHERE len(w) >= n)),
h AS (SELECT DISTINCT doc_id, k, g.n, item_id FROM g JOIN p USING (part)),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS k FROM h),
o AS (SELECT doc_id, (j + 1) // 2 AS k, a, a + len AS e FROM (SELECT doc_id, j, length(piece) AS len, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM (SELECT doc_id, unnest(s) AS piece, unnest(range(len(s))) AS j FROM (SELECT doc_id, string_split(regexp_replace(raw, '([0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+)', concat(chr(1), '\1', chr(1)), 'g'), chr(1)) AS s FROM d SEMI JOIN h USING (doc_id)))) WHERE j % 2 = 1),
r AS (SELECT doc_id, min(a)::BIGINT AS a, max(e)::BIGINT AS e FROM (SELECT doc_id, a, e, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM c JOIN o USING (doc_id, k)) GROUP BY doc_id, run),
q AS (SELECT doc_id, string_agg(concat(a, ':', e), ',' ORDER BY a) AS spans FROM r GROUP BY doc_id), n AS (SELECT doc_id, count(*) AS n_hit FROM c GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated, coalesce(spans, '') AS hit_spans
FROM dw LEFT JOIN n ON n.doc_id = dw.doc_id LEFT JOIN i ON i.doc_id = dw.doc_id LEFT JOIN q ON q.doc_id = dw.doc_id"""

_NEAR = rf"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k : k + 3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.v, r.c FROM r JOIN l ON r.doc_id = l.u WHERE r.c < l.v)
SELECT s.doc_id, len(s.s) AS n_shingles, min(c) AS component_id, s.doc_id = min(c) AS kept FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s"""

#: The template without escapes: turns hold no control strings but those of conversation -7.
_ESCAPED = r"regexp_replace(text, '(\\|#{3,}|</turn>)', '\\\1', 'g')"

ORACLES = {
    "op1_chat_format": rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT *, (regexp_matches(text, '#{{3,}}|</turn>') OR contains(text, '\\')) AS hard FROM c),
r AS (SELECT *, length(concat('### ', role, ': ', CASE WHEN hard THEN {_ESCAPED} ELSE text END, ' </turn>', chr(10))) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
sum(n)::BIGINT AS formatted_chars, count(*) FILTER (hard) AS escaped_turns, true AS identical FROM r GROUP BY conv_id""",
    "op7_exact_dedup": f"""WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, {_BARE} AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op2_near_dedup": _NEAR,
    "op5_pii": _PERSONAL,
    "op8_license_scan": _LICENSES,
    "op10_decontaminate": _CONTAMINATED,
}
