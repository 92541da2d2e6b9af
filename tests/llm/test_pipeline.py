"""Every stage of the pipeline against brute force, on awkward, repeated and empty tables whose further columns have awkward names."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import language_id, mixing
from tessella.llm.queries import tokenizer_path
from tests.llm.test_contracts import lower, sets_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, _row int, _size int, _key string, salt int"


def rows():
    rng = np.random.default_rng(8)
    words = {"en": "the of and to in with from that", "fr": "le la des une dans pour avec elle"}
    made = []
    for k in range(60):
        lang = ("en", "fr")[k % 2]
        made.append((k, " ".join(rng.choice(words[lang].split(), 40)) + f" u{k} v{k} w{k}", lang, ("s1", "s2", "s3", None)[k % 4]))
    item = " ".join(f"q{k}" for k in range(20))
    made += [(100, made[0][1], "en", "s1"), (100, made[0][1], "en", "s1"), (None, made[1][1] + " x", "fr", None), (None, None, None, None), (101, "", "en", "s2"), (102, " \n", None, "s2"), (None, "123", "en", "s1")]
    made += [(103, made[2][1] * 40 + " " + " ".join(item.split()[3:16]), "en", "s1"), (104, made[3][1] + " " + " ".join(item.split()[:12]), "fr", "s2"), (105, "short " + item, "en", "s1")]
    made += [(106, "one two three", "en", "s9"), (106, "another text of its own id", "en", "s9"), (2, made[4][1] + " tail", "en", "s1"), (107, "the word of " * 9000, "en", "s1")]
    return [(d, t, lang, s, None if t is None else len(t), "x.y", 7, 8, "k", 9) for d, t, lang, s in made], item


@pytest.fixture(params=["rows", "empty"])
def given(request, spark, tmp_path):
    made, item = rows()
    docs = spark.createDataFrame(made if request.param == "rows" else [], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "one two three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs, str(tmp_path), item


def kept(df, docs):
    assert df.columns == docs.columns and df.schema == docs.schema
    return Counter(tuple(r) for r in df.collect())


def test_language(spark, given):
    docs, folder, _ = given
    net = language_id.train(language_id.training_sample(docs))
    said = {r.text: (r.lang_pred, r.score) for r in language_id.identify(docs, net, text_too=True).collect()}
    want = Counter(tuple(r) for r in docs.collect() if said[r.text][0] != "und" and said[r.text][1] >= corpus_pipeline.LEAST_SCORE)
    assert kept(corpus_pipeline.language(spark, docs, folder), docs) == want
    assert not any(text is None or not any(map(str.isalpha, text)) for _, text, *_ in want)


def test_near_duplicates(spark, given):
    docs, folder, _ = given
    all_rows = [tuple(r) for r in docs.collect()]
    sets = [sets_of(r[1], 5) for r in all_rows]
    root = list(range(len(all_rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(all_rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(all_rows)):
        groups[find(i)].append(i)
    got = kept(corpus_pipeline.near_duplicates(spark, docs, folder), docs)
    assert sum(got.values()) == len(groups)
    left = +got
    for members in groups.values():
        least = min((all_rows[i][0] is None, all_rows[i][0] or 0) for i in members)
        fit = [i for i in members if (all_rows[i][0] is None, all_rows[i][0] or 0) == least and left[all_rows[i]]]
        assert fit, least
        left[all_rows[fit[0]]] -= 1


def test_decontamination(spark, given):
    docs, folder, item = given
    q = item.split()
    windows, short = {tuple(q[k : k + 13]) for k in range(len(q) - 12)}, ("one", "two", "three")

    def clean(t):
        w = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in lower(t or "")).split()
        if any(tuple(w[k : k + 13]) in windows for k in range(len(w))):
            return False
        hit = {k + j for k in range(len(w)) if tuple(w[k : k + 3]) == short for j in range(3)}
        return not hit or 100 * len(hit) < 5 * len(w)

    want = Counter(tuple(r) for r in docs.collect() if clean(r.text))
    assert kept(corpus_pipeline.decontamination(spark, docs, folder), docs) == want
    if docs.count():
        assert not {r[0] for r in want} & {103, 105} and {r[0] for r in want} >= {104}  # a window in a long text, 12 words of one


def test_mix(spark, given):
    docs, folder, _ = given
    got = corpus_pipeline.mix(spark, docs, folder)
    assert got.schema == docs.schema
    found, texts = Counter(), defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id, r.source] |= set((r.text or "").split())
    for r in got.collect():
        assert set(r.text.split()) <= texts[r.doc_id, r.source] and r.n_chars == len(r.text) and r["a.b"] == "x.y"
        found[r.doc_id] += len(r.text.split())
    want = Counter()
    for r in mixing.Mix(docs).taken().collect():
        want[r.doc_id] += r.taken
    assert found == +want


def test_tokens(spark, given):
    from tokenizers import Tokenizer

    docs, folder, _ = given
    made = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in docs.collect():
        ids = [*made.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = sorted((tuple(r) for r in corpus_pipeline.tokens(spark, docs, folder).collect()), key=lambda r: r[1])
    assert Counter((d, n, crc) for d, _, n, crc in got) == want
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda d: (d is not None, d or 0))


def test_run_is_its_stages(spark, given):
    docs, folder, _ = given
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{folder}/stage-{name}"
        stage(spark, step, folder).write.parquet(path)
        step = spark.read.parquet(path)
    texts = Counter(r.doc_id for r in step.select(F.col("doc_id")).collect())
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.doc_id for r in got) == texts and [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mix", "tokens"]
