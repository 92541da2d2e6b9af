"""Each operator against a brute-force version, over awkward rows and over a whole small table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessella.llm import chat, decontaminate, exact_dedup, mixing, near_dedup, pii, queries, token_files
from tests.llm.helpers import awkward, frame

BLANK = re.compile(r"[\x20\x09-\x0D]")


@pytest.fixture(params=["awkward", "table", "empty"])
def docs(request, spark, sf):
    if request.param == "table":
        return spark.read.parquet(f"{sf}/documents.parquet")
    return frame(spark, awkward() if request.param == "awkward" else [])


def rows_of(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def test_exact_dedup(spark, docs):
    given = rows_of(docs)
    groups = defaultdict(list)
    for d, t, _ in given:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), d is None, d or 0))
    want = Counter()
    for d, t, _ in given:
        n = BLANK.sub("", t or "")
        size, none, keep = min(groups[n])
        keep = None if none else keep
        want[(d, keep, len(groups[n]), d == keep and len(t or "") == -size, sha(n))] += 1
    for hash_of in (exact_dedup.content_hash, lambda norm: __import__("pyspark").sql.functions.unhex(__import__("pyspark").sql.functions.substring(__import__("pyspark").sql.functions.md5(norm), 1, 2))):
        got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs, hash_of).collect())
        assert got == want


def sets_of(t, width):
    w = lower(t or "").encode()
    w = [x.decode() for x in re.split(rb"[\x20\x09-\x0D]+", w) if x]
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def test_components_with_hubs(spark):
    """Hubs of more neighbours than `hot`, chains, and edges given in both directions."""
    from tessella.llm.components import components

    rng = np.random.default_rng(4)
    edges = [(1000, k) for k in range(200)] + [(k, k + 1) for k in range(2000, 2040)] + [(2005, 1000)] + [(int(a), int(b)) for a, b in rng.integers(3000, 3100, (60, 2))] + [(5, 1000), (7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    made = spark.createDataFrame(edges, "u long, v long")
    for hot in (16, 1 << 14):
        assert {(r.node, r.root) for r in components(made, hot).collect()} == {(x, find(x)) for x in root}
    assert components(made.limit(0)).count() == 0


def test_join_groups(spark):
    """The same rows whether all groups are broadcast, or only the large ones."""
    from tessella.llm import common

    rows = spark.createDataFrame([(k % 3 if k < 60 else k, k) for k in range(100)], "key long, x long")
    groups = common.cut(rows.groupBy("key").count().withColumnRenamed("count", "n").where("key <> 70"))
    want = sorted(tuple(r) for r in rows.join(groups, "key").collect())
    old, common.HOT = common.HOT, 5
    try:
        got = [sorted(tuple(r) for r in common.join_groups(rows, groups, "key", "n", 10, limit).collect()) for limit in (1 << 20, 100)]
    finally:
        common.HOT = old
    assert got == [want, want] and len(want) == 99
    assert common.join_groups(rows, groups.limit(0), "key", "n", 10).count() == 0


@pytest.mark.parametrize("width", [4, 5])
def test_near_dedup(spark, docs, width):
    given = rows_of(docs)
    sets = [sets_of(t, width) for _, t, _ in given]
    root = list(range(len(given)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(given):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = Counter()
    for i, (d, _, _) in enumerate(given):
        c = least.get(find(i))
        want[(d, len(sets[i]), c, c is None or d == c)] += 1
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, width=width).collect())
    assert got == want


def test_near_dedup_rest_pass(spark, monkeypatch):
    """Two similar texts meet only in the bucket of a third that is similar to neither: with one band of one coordinate,
    texts that share the shingle of the least value are all of one bucket, whose star is the smallest id."""
    for seed in range(40):
        core, other, near = ([f"{x}{seed}_{k}" for k in range(n)] for x, n in (("c", 40), ("o", 20), ("n", 20)))
        texts = [" ".join(core + other), " ".join(core + near), " ".join([*core, *near[:-1], "z"])]
        sets = [near_dedup.shingle_sets([t], 4).__next__() for t in texts]
        if len(set(near_dedup.signatures(sets, 1)[:, 0].tolist())) == 1:
            break
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    run = lambda: {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, width=4, bands=1, rows=1).collect()}
    assert run() == {0: 0, 1: 1, 2: 1}
    real = near_dedup._rest
    monkeypatch.setattr(near_dedup, "_rest", lambda *a: real(*a).limit(0))
    assert run() == {0: 0, 1: 1, 2: 2}


def test_near_dedup_without_ids(spark):
    """Rows without doc_id link to similar texts, and bridge two that aren't similar to each other."""
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words[k : k + 50]) for k in (0, 4, 8)]
    docs = spark.createDataFrame([(7, texts[0]), (None, texts[1]), (9, texts[2]), (None, "far " + texts[0][::-1]), (None, None)], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, width=4).collect())
    assert got == Counter([(7, 7, True), (None, 7, False), (9, 7, False), (None, None, True), (None, None, True)])


def test_pipeline_row_decisions(spark, tmp_path):
    """The near-duplicate and decontamination stages against brute force, with null and repeated ids."""
    import corpus_pipeline

    rng = np.random.default_rng(3)
    bodies = [" ".join(f"u{x}" for x in rng.integers(0, 900, 60)) for _ in range(8)]
    near = [b + " tail" for b in bodies[:4]]
    item = " ".join(f"q{k}" for k in range(20))
    rows = [(None, bodies[0]), (None, near[0]), (None, bodies[1]), (4, near[1]), (4, bodies[2]), (5, bodies[3]), (5, bodies[3]), (5, bodies[3]), (None, None), (None, "")]
    rows += [(6, bodies[4]), (6, bodies[5]), (3, near[3]), (None, bodies[6] + " " + item), (8, item + " x"), (8, bodies[7]), (None, item)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([("b", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    sets = [sets_of(t, 5) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[find(i)].append((d is None, d or 0))
    got = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert Counter((d is None, d or 0) for d, _ in kept) == Counter(min(g) for g in groups.values())
    at = [[i for i, row in enumerate(rows) if row == k] for k in kept]
    assert sorted(find(i[0]) for i in at) == sorted(groups)

    windows = {tuple(item.split()[k : k + 13]) for k in range(8)}

    def contaminated(t):
        w = (t or "").split()
        hit = {k + j for k in range(len(w)) if tuple(w[k : k + 13]) in windows for j in range(13)}
        return bool(hit) and 100 * len(hit) >= 5 * len(w)

    clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r in rows if not contaminated(r[1]))


PY = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(t):
    out = []
    for kind, pattern in PY.items():
        for m in re.finditer(pattern, t or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                odd = sum(int(c) for c in digits[::-1][::2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[::-1][1::2])
                if not 16 <= len(digits) <= 19 or odd % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PERSONAL = [
    "mail a@b.co.uk, x_y@d.e@f.gh a@b.com.x_y@d.e @ a@b a@-.- \x01a@b.c\x01 é@b.c ü1@b.c.",
    "1.2.3.4 256.1.1.1 001.2.3.255 1.2.3.4.5.6.7.8 1.2.3 99999999999999999999.1.1.1",
    "4539 1488 0343 6467 and 4539-1488-0343-6467 4539148803436467 4539148803436468 4539148803436467 1 0000000000000000000 1 2",
    "+1 (171) 555-2028 thha +1 +12345678 +1234567 +123456789012345 +1234567890123456 +44 20 7946 0958 ) ",
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, GB82WEST12345698765433; ssn 123-45-6789 or 123-45-6789",
    "\U0001f600 a@b.cc " * 300,
    "a" * 200000 + "@b.c",
    "1 " * 50000,
    "+1 " * 20000,
]


def test_pii(spark, docs):
    extra = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(PERSONAL)], "doc_id long, text string")
    for given in (docs.select("doc_id", "text").unionByName(extra), docs):
        rows = given.collect()
        got = sorted(((r.doc_id, [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in pii.BASE]) for r in pii.personal_data(given).collect()), key=repr)
        assert got == sorted(((r.doc_id, base_spans(r.text)) for r in rows), key=repr)


def test_pii_method(spark):
    found = {r.doc_id: [(s.kind, PERSONAL[4][s.start : s.end]) for s in r.spans] for r in pii.personal_data(spark.createDataFrame([(1, PERSONAL[4])], "doc_id long, text string")).collect()}
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in found[1] and ("iban", "DE89370400440532013000") in found[1]
    assert [x for x in found[1] if x[0] == "ssn"] and not [x for x in found[1] if "33;" in x[1] or x[1].endswith("433")]


def test_pii_iban_before_upper_case(spark):
    ibans = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606"]
    after = ["", " EUR 500", " BIC: COBADEFFXXX", " BIC COBADEFFXXX", " 12 34", ", then"]
    rows = [(k, f"IBAN {x}{y}", x) for k, (x, y) in enumerate((x, y) for x in ibans for y in after)]
    rows += [(900, "IBAN DE89370400440532013000EUR", None), (901, "IBAN DE89370400440532013001 EUR", None)]
    texts = {k: t for k, t, _ in rows}
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, iban string")).collect()
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "iban"] for r in found}
    assert got == {k: [x] if x else [] for k, _, x in rows}


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    hashed = docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    given = [(r.doc_id, [*t.encode(r.text or "", add_special_tokens=False).ids, 1], r.h) for r in hashed]
    given.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], np.array(r[1], "<u2").tobytes()))
    want, at = [], 0
    for d, ids, _ in given:
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    folder = str(tmp_path / "tokens")
    token_files.PART_DOCS = 16  # several parts
    token_files.write_tokens(docs, folder, queries.tokenizer_path())
    token_files.PART_DOCS = 16_384
    got = [tuple(r) for r in token_files.read_tokens(spark, folder).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_encoder_matches_whole_texts():
    made = token_files.Encoder(queries.tokenizer_path(), 1)
    texts = ["", " ", "A<|endoftext|>b c", "x\x1cy\x85z\xa0w", "é ́a", "it's we'll 12 <|startoftext|>", "Ünï　日本 \U0001f600!", "İİ ſ", "a. b, c., d's. é. x.y. No.1, ٣. .. , a,", "o'er, don't. 's"]
    for memo in (10**6, 3):
        token_files.MEMO = memo
        assert [np.frombuffer(x, "<u2").tolist() for x in made.encode(texts)] == [[*made.ids(t), 1] for t in texts]
    token_files.MEMO = 200_000


def test_encoder_collisions_and_other_tokenizers(monkeypatch, tmp_path):
    """Runs that share a hash, in a batch or with a remembered one, and a tokenizer of another kind: texts are encoded as they are."""
    texts = ["one two three one", "four two", "", "one five, six. one"]
    made = token_files.Encoder(queries.tokenizer_path(), 1)
    assert made.apart
    want = [[*made.ids(t), 1] for t in texts]
    ids = lambda e, ts: [np.frombuffer(x, e.dtype).tolist() for x in e.encode(ts)]
    real = token_files.span_hashes
    monkeypatch.setattr(token_files, "span_hashes", lambda b, s, e: real(b, s, e) % np.uint64(3))
    assert ids(made, texts) == want
    monkeypatch.setattr(token_files, "span_hashes", lambda b, s, e: (e - s).astype(np.uint64))
    assert [ids(made, [t])[0] for t in ("abc", "abd", "abc")] == [[*made.ids(t), 1] for t in ("abc", "abd", "abc")]
    monkeypatch.undo()
    other = token_files.Encoder(queries.tokenizer_path("byte_bpe_50k.json"), 1)
    assert not other.apart and ids(other, texts) == [[*other.ids(t), 1] for t in texts]


def test_mixing(spark, docs):
    given = rows_of(docs)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = defaultdict(int)
    for _, t, s in given:
        totals[s] += size(t)
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    goal, held = {}, set()
    while True:
        free = [s for s in names if s not in held]
        left = sum(totals.values()) - sum(3 * totals[s] for s in held)
        goal = {s: 3 * totals[s] if s in held else left * weight[s] / sum(weight[x] for x in free) for s in names}
        above = {s for s in free if goal[s] > 3 * totals[s]}
        if not above:
            break
        held |= above
    m = mixing.Mix(docs, block_words=8)
    got = [tuple(r) for r in m.taken().collect()]
    back = {(d, n) for d, n, *_ in got}
    assert Counter((d, n) for d, n, *_ in got) == Counter((d, size(t)) for d, t, _ in given) and len(back) <= len(given)
    by = defaultdict(int)
    for d, n, total, target, taken in got:
        assert taken <= 3 * n
    for s in names:
        want = round(goal[s], 6)
        own = [r for r in got if round(r[3], 6) == want and r[2] == totals[s]]
        assert own
    words = sum(r[4] for r in got)
    assert abs(words - sum(totals.values())) <= 0.02 * sum(totals.values()) + 16
    assert Counter(got) == Counter(tuple(r) for r in mixing.Mix(docs, block_words=8).taken().collect())
    number = {k: n for k, n in enumerate(m.names)}
    for r in m.slots().groupBy("number").count().collect():
        by[number[r.number]] = r["count"] * 8
    for s in names:
        assert abs(by[s] - goal[s]) <= 0.05 * goal[s] + 48, s


def test_mixing_rows_hold_the_words_taken(spark, docs):
    m = mixing.Mix(docs, block_words=8)
    rows = m.rows(docs)
    assert rows.schema == docs.schema
    got = defaultdict(int)
    for r in rows.collect():
        got[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text)
    want = defaultdict(int)
    for r in m.taken().collect():
        want[r.doc_id] += r.taken
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_decontamination(spark, sf, docs):
    bench = [(1, "one two"), (1, "three"), (10, ""), (11, None), (None, "x1 no"), (2, " ".join(f"W{k}," for k in range(30))), (3, "ONE")]
    given = [(r.doc_id, r.text) for r in docs.collect()] + [(500, "x " + " ".join(f"w{k}" for k in range(4, 25)) + " y"), (501, "one two three one"), (502, "1one two")]
    tables = [(given, bench)]
    if docs.columns[-1] == "n_chars":
        tables.append((given, [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    for rows, items in tables:
        windows = defaultdict(set)
        for i, t in items:
            w = split(t)
            for k in range(max(1, len(w) - 12) if w and i is not None else 0):
                windows[tuple(w[k : k + 13])].add(str(i))
        lengths = {len(w) for w in windows}
        want = []
        for d, t in rows:
            w = split(t)
            hit, ids = set(), set()
            for n in lengths:
                for k in range(len(w) - n + 1):
                    if own := windows.get(tuple(w[k : k + n])):
                        hit |= set(range(k, k + n))
                        ids |= own
            want.append((d, len(w), len(hit), len(ids), sha(",".join(sorted(ids)))))
        made = spark.createDataFrame(rows, "doc_id long, text string")
        asked = spark.createDataFrame(items, "item_id long, text string")
        got = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), r.items_sha256) for r in decontaminate.contamination(made, asked).collect()]
        assert Counter(got) == Counter(want)


def test_decontamination_offsets(spark):
    docs = spark.createDataFrame([(1, "É! One,  TWO; é one")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    (row,) = decontaminate.contamination(docs, asked).collect()
    assert [("É! One,  TWO; é one")[s.start : s.end] for s in row.hit_spans] == ["One,  TWO"]


def test_chat(spark, sf):
    hard = [r"\### Assistant: </turn> ok", "### User: x", "a </turn>\n### User: b", "\\", "\\\\", "####", "\\####\\", "</turn>", " </turn>", "</turn>\n", "\n", "", None, "x\\</turn>", "plain # ## text", "é\U0001f600 </turn> é", "#" * 5000 + "</turn>" * 5000]
    rows = [(1, k, r, t, "x") for k, t in enumerate(hard) for r in ("user", "assistant")]
    rows += [(2, 0, "tool: a\\b\n", "t", "x"), (2, None, None, "first", "x"), (2, 0, "User", "=u", "x"), (2, 0, "User", "=u", "x"), (None, 1, "assistant", "z", "x")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, shown string")
    real = spark.read.parquet(f"{sf}/conversations.parquet")
    for df in (given, real, given.limit(0)):
        convs = defaultdict(list)
        for r in df.collect():
            convs[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
        want = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in convs.items()}
        seen = 0
        for r in chat.format_conversations(df).withColumn("loss", chat.loss_text(__import__("pyspark").sql.functions.col("formatted"), __import__("pyspark").sql.functions.col("loss_mask"))).collect():
            seen += 1
            assert r.identical
            assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
            assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert seen == len(want)


def test_language_contract(spark, docs):
    from tessella.llm import language_id

    net = language_id.train(language_id.training_sample(docs))
    got = Counter((r.doc_id, r.held_out, r.lang_pred == "und") for r in language_id.identify(docs, net).collect())
    letter = lambda t: any(map(str.isalpha, t or ""))
    want = Counter((d, d is None or zlib.crc32(str(d).encode()) % 5 == 0, not (letter(t) and net.langs)) for d, t, _ in rows_of(docs))
    assert got == want


def test_language_labels_and_pooling(spark, docs):
    """Predictions against a plain loop over the cells, position by position; segments come from whole texts."""
    from tessella.llm import language_id

    sample = language_id.training_sample(docs, segments=3)
    texts = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    learnable = [(lang, t.encode()) for d, lang, t in texts if d is not None and zlib.crc32(str(d).encode()) % 5 and lang is not None and t is not None]
    assert all(any(lang == own and piece in raw for own, raw in learnable) for lang, piece in sample)
    net = language_id.train(sample, epochs=2)
    if len(net.langs) < 2:
        return
    said = {(r.text, r.lang_pred, r.score) for r in language_id.identify(docs, net, text_too=True).collect() if r.text and len(r.text) < 400}
    for text, lang, score in sorted(said)[:12]:
        if not any(map(str.isalpha, text)):
            assert (lang, score) == ("und", 0.0)
            continue
        raw, total = text.encode(), np.zeros(len(net.langs))
        for at in range(0, len(raw), language_id.STEPS):
            x = np.zeros(language_id.STEPS, np.intp)
            piece = raw[at : at + language_id.STEPS]
            x[: len(piece)] = list(piece)
            states = {}
            for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
                h = np.zeros((1, net.hidden), np.float32)
                for t in order:
                    h = states[d, t] = net.cell(d, h, x[t : t + 1])
            for t in range(len(piece)):
                z = (states["f", t] @ net.p["Of"] + states["b", t] @ net.p["Ob"] + net.p["b"])[0].astype(np.float64)
                total += np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert abs((total / len(raw)).max() - score) < 2e-3
        assert net.langs[int(total.argmax())] == lang or np.ptp(np.sort(total)[-2:]) < 1e-2 * len(raw)


def test_network_gradients():
    from tessella.llm.language_id import Network

    net = Network(["a", "b", "c"], hidden=3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (5, 4)), np.array([0, 1, 2, 1])
    grads = net.gradients(x, y)

    def loss():
        states = []
        for d, order in (("f", range(5)), ("b", range(4, -1, -1))):
            h, out = np.zeros((4, 3)), [None] * 5
            for t in order:
                h = out[t] = net.cell(d, h, x[t])
            states.append(np.stack(out))
        z = states[0] @ net.p["Of"] + states[1] @ net.p["Ob"] + net.p["b"]
        z -= np.log(np.exp(z).sum(axis=2, keepdims=True))
        return -z[:, np.arange(4), y].mean()

    for k, g in grads.items():
        for at in list(np.ndindex(g.shape))[:: max(1, g.size // 40)] + [(int(x[0, 0]), j) for j in range(9) if k[0] == "E"]:
            old = net.p[k][at]
            net.p[k][at] = old + 1e-5
            up = loss()
            net.p[k][at] = old - 1e-5
            down = loss()
            net.p[k][at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4, (k, at)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op3_language_id(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    held = [(rows[d.doc_id].lang_pred == d.lang) for d in docs if rows[d.doc_id].held_out]
    assert sum(held) >= 0.97 * len(held)


def tox_words(text):
    """The features of a text by plain loops: words, and beginnings of 5 and 7 bytes of longer words."""
    words = set("".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lower(text or "")).encode().split())
    return words | {(n, w[:n]) for w in words for n in (5, 7) if len(w) > n}


def test_toxicity_chain_by_hand(spark):
    """Two categories over a few rows against a dense chain with the same folds, step by step."""
    from tessella.llm import toxicity

    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.choice(12, 6)) for _ in range(60)]
    y = [[int("w1" in t.split()), int("w2" in t.split() or "w1" in t.split() and "w3" in t.split())] for t in texts]
    chain = toxicity.train([(toxicity.words_of(t).tobytes(), v) for t, v in zip(texts, y, strict=True)])
    names = sorted({w for t in texts for w in tox_words(t) if sum(w in tox_words(u) for u in texts) >= toxicity.LEAST_DOCS}, key=repr)
    assert len(chain.vocabulary) == len(names)
    x, y = np.array([[float(w in tox_words(t)) for w in names] for t in texts]), np.array(y, float)

    def fit(x, before, y):
        there, n, ones = x[y == 1].sum(axis=0), len(y), y.sum()
        ratio = np.log((there + 1) / (ones + 2)) - np.log((x.sum(axis=0) - there + 1) / (n - ones + 2))
        full = np.hstack([x * ratio, before, np.ones((n, 1))])
        p, m, v = (np.zeros(full.shape[1]) for _ in range(3))
        decay = np.array([2e-3] * (full.shape[1] - 1) + [0.0])
        for t in range(1, 61):
            g = full.T @ ((1 / (1 + np.exp(-full @ p)) - y) / n) + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        return lambda a, b: 1 / (1 + np.exp(-(np.hstack([a * ratio, b, np.ones((len(a), 1))]) @ p)))

    fold, before, shown = np.arange(60) % 5, np.zeros((60, 0)), np.zeros((60, 0))
    for k in range(2):
        apart = np.zeros(60)
        for f in range(5):
            apart[fold == f] = fit(x[fold != f], before[fold != f], y[fold != f, k])(x[fold == f], before[fold == f])
        model = fit(x, before, y[:, k])
        shown = np.hstack([shown, model(x, shown)[:, None]])
        before = np.hstack([before, apart[:, None]])
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, toxic int")
    got = np.array([(r.low_quality, r.toxic) for r in sorted(toxicity.toxicity(docs, chain).collect())])
    assert np.abs(got - shown).max() < 1e-5


def test_toxicity(spark, docs):
    from tessella.llm import toxicity

    base = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{base}/labels.parquet")
    own = spark.read.parquet(f"{base}/documents.parquet")
    held = labels.where("doc_id % 4 = 0")
    chain = toxicity.train(toxicity.training_sample(own, labels.where("doc_id % 4 <> 0")))
    said = {r.doc_id: r.toxic for r in toxicity.toxicity(own, chain).collect()}
    truth = {r.doc_id: r.toxic for r in held.collect()}
    assert sum((said[d] >= 0.5) == bool(t) for d, t in truth.items()) >= 0.95 * len(truth)
    for made in (chain, toxicity.train([])):
        got = toxicity.toxicity(docs, made).collect()
        assert Counter(r.doc_id for r in got) == Counter(d for d, _, _ in rows_of(docs))
        assert all(0 <= r.toxic <= 1 and 0 <= r.low_quality <= 1 for r in got)
    texts = {d: t for d, t, _ in rows_of(docs)}
    none = {r.toxic for r in toxicity.toxicity(docs, chain).collect() if r.doc_id is not None and not tox_words(texts[r.doc_id])}
    assert len(none) <= 1  # texts without words get what the intercepts say


def test_toxicity_sample(spark):
    """Repeated ids, null labels, missing documents; the bound holds over rows."""
    from tessella.llm import toxicity

    docs = spark.createDataFrame([(1, "a b"), (1, "a c"), (2, "d"), (3, None), (None, "e"), (4, ""), (5, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 1), (2, None, 0), (3, 1, 0), (None, 1, 1), (4, 1, None), (9, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    h = lambda t: toxicity.words_of(t).tobytes()
    assert Counter((w, tuple(v)) for w, v in toxicity.training_sample(docs, labels)) == Counter([(h("a b"), (1, 1)), (h("a c"), (1, 1)), (h("d"), (0, 0)), (h("x"), (0, 0))])
    assert len(toxicity.training_sample(docs, labels, per_class=1)) == 2


def reflowed(text, width):
    """Paragraphs filled to a width; copyright lines stay lines."""
    import textwrap

    out = []
    for part in re.split(r"\n\s*\n|(?<=\n)(?=[ \t]*copyright [(\[<0-9y])", text, flags=re.I):
        out.append(part if re.match(r"\s*copyright", part, re.I) else textwrap.fill(" ".join(part.split()), width, break_on_hyphens=False, break_long_words=False))
    return "\n\n".join(out)


def test_licenses(spark, docs):
    from tessella.llm import licenses

    mit, isc = licenses.TEXTS[0][1], next(t for k, t in licenses.TEXTS if k == "ISC")
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper(), "MIT", []), (2, "prose\nReleased under the MIT Licence\n\nLicensed under CC BY-NC 4.0. ", None, ["CC-BY-NC-4.0", "MIT"])]
    rows += [(3, mit + " more", None, []), (4, None, None, []), (5, "MIT Licence\n" + mit.replace("sublicense", "sub-license"), "MIT", [])]
    rows += [(6, "ISC License\n\nCopyright Jane Doe\nCopyright 2001-2003 by Another, Inc.\nAll rights reserved.\n\n" + isc, "ISC", [])]
    rows += [(7, "/*\n" + "\n".join(" * " + x for x in isc.split("\n")) + "\n */", "ISC", []), (8, isc.replace("provided that the above copyright", "provided that the above\ncopyright"), "ISC", [])]
    rows += [(9, isc.replace("copyright notice", ""), None, []), (10, "Released under the MIT license\n" * 3, None, ["MIT"]), (None, "Released under the MIT license.", "MIT", ["MIT"])]
    rows[9], rows[10] = (10, "x\n" + "Released under the MIT license\n" * 3, None, ["MIT"]), (None, "y\nReleased under the MIT license.", None, ["MIT"])
    given = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.notices) for r in licenses.license_scan(given).collect()}
    assert got == {d: (k, n) for d, _, k, n in rows}
    assert Counter(r.doc_id for r in licenses.license_scan(docs).collect()) == Counter(d for d, _, _ in rows_of(docs))


def test_licenses_however_wrapped(spark):
    """Each known text at ten widths; those known by digest are read from the system where it has them."""
    from pathlib import Path

    from tessella.llm import licenses

    files = {"Apache-2.0": "Apache-2.0", "Artistic-1.0": "Artistic", "BSD-3-Clause-UC": "BSD", "CC0-1.0": "CC0-1.0", "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.0": "LGPL-2", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3"}
    known = [*licenses.TEXTS, *((k, p.read_text(errors="replace")) for k, f in files.items() if (p := Path("/usr/share/common-licenses", f)).exists())]
    rows = [(n, reflowed(t, w), k) for n, ((k, t), w) in enumerate((x, w) for x in known for w in (60, 66, 70, 72, 74, 76, 78, 80, 90, 100))]
    rows += [(-1 - n, t, k) for n, (k, t) in enumerate(known)]
    given = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.license_scan(given).collect()}
    assert got == {n: k for n, _, k in rows}
    canon = given.select(licenses.canonical(given.text).alias("c")).collect()
    assert all(any(a in r.c for a in licenses.ANCHORS) for r in canon)
    assert all(any(a in t.lower() for a in licenses.ANCHORS) for _, t in [*known, *licenses.NOTICES])


def test_permutation_is_one():
    for n in (1, 2, 3, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5).tolist()) == list(range(n))
