"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. Each model is a logistic regression over the presence of words and the
probabilities of the categories before it; those probabilities come, in training, from models that didn't see the
row (out-of-fold predictions), so that later models learn how far earlier ones can be trusted.

The categories are what the labels know: low_quality (quality 0), then toxic. No list of words is given; what
marks a category is learned from the labelled rows of all languages.

Training uses a bounded sample: at most `per_class` labelled documents of each class of the last category, the first by
hash. Words are lower-case runs of ASCII letters, digits and other characters; the features are the words, and beginnings of
words, found in at least `least_docs` sample documents, by exact 64-bit hash. They are taken from whole texts where
the texts are, in training as in prediction; only hashes come to the driver.

Defined results: a null or empty text has no words, so it gets what the intercepts say; rows whose toxic label is null, or whose
document is missing, aren't learned from, and a null label of an earlier category counts as 0; without both classes of a
category in the sample its probability is the share of ones. Labels that repeat a doc_id count once for each of their
values, documents that repeat one up to the bound, ties in the order of their words; equal texts get equal probabilities, and each row of
the input is a row of the result, whatever else is null or repeated. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import lean, small_batches
from tessella.llm.decontaminate import KEEP
from tessella.llm.shingles import mix, power_tables, span_hashes, spans_and_hashes

PER_CLASS = 2500
LEAST_DOCS = 4
#: Bytes of the beginnings that are features.
BEGINNINGS = (5, 7)
FOLDS = 5
#: Categories in the order of the chain, and the label value that means yes.
CATEGORIES = {"low_quality": ("quality", 0), "toxic": ("toxic", 1)}


def words_of(text: str | None) -> np.ndarray:
    """Distinct hashes of words and of the beginnings of longer words (compounds share their first stem), sorted."""
    if not text:
        return np.zeros(0, np.uint64)
    buffer = np.frombuffer(text.encode().lower().translate(KEEP), np.uint8)
    starts, ends, found = spans_and_hashes(buffer)
    parts = [found]
    for n in BEGINNINGS:
        long = ends - starts > n
        parts.append(mix(span_hashes(buffer, starts[long], starts[long] + n) + np.uint64(n)))
    return np.unique(np.concatenate(parts))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, categories: dict[str, tuple[str, int]] = CATEGORIES) -> list[tuple[bytes, list[int]]]:
    """(word hashes, values of the categories) of at most `per_class` documents of each class of the last category. Ids are
    ranked first, texts read for those alone, and ranked once more where rows repeat an id."""
    asked = [F.coalesce((F.col(c) == yes).cast("int"), F.lit(0) if k < len(categories) - 1 else F.lit(None).cast("int")).alias(name) for k, (name, (c, yes)) in enumerate(categories.items())]
    last = list(categories)[-1]
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *asked).where(f"doc_id IS NOT NULL AND {last} IS NOT NULL").distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id"), *categories]
    chosen = known.withColumn("rank", F.row_number().over(Window.partitionBy(last).orderBy(*order))).where(F.col("rank") <= per_class).drop("rank")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).where("text IS NOT NULL")
    rows = texts.join(F.broadcast(chosen), "doc_id")  # two classes of per_class rows at most
    hashed = rows.mapInArrow(lean("toxicity", _hashed(list(categories)), power_tables.clear), "doc_id long, digest long, words binary, " + ", ".join(f"{c} int" for c in categories))
    bounded = hashed.withColumn("rank", F.row_number().over(Window.partitionBy(last).orderBy(*order, "digest"))).where(F.col("rank") <= per_class)
    return [(bytes(r.words), [r[c] for c in categories]) for r in bounded.orderBy("doc_id", *categories, "digest").collect()]


def _hashed(categories: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [words_of(t.as_py()) for t in batch["text"]]
            digests = [int(np.bitwise_xor.reduce(mix(w)).view(np.int64)) if len(w) else 0 for w in words]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(digests, pa.int64()), pa.array([w.tobytes() for w in words], pa.binary()), *(batch[c] for c in categories)], names=["doc_id", "digest", "words", *categories])

    return run


class Linear:
    """Logistic regression on sparse presence features and a few dense ones."""

    def __init__(self, vocabulary: int, dense: int):
        self.w, self.d, self.b = np.zeros(vocabulary), np.zeros(dense), 0.0

    def margin(self, flat: np.ndarray, rows: np.ndarray, dense: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(rows, self.w[flat], n) + dense @ self.d + self.b

    def fit(self, flat: np.ndarray, rows: np.ndarray, dense: np.ndarray, y: np.ndarray, rounds: int = 60, decay: float = 2e-3) -> Linear:
        """Full-batch Adam on the mean loss with an L2 penalty.

        Word features are scaled by the log ratio of their smoothed shares in both classes, so that the penalty falls
        on words that tell little.
        """
        n, ones = len(y), float(y.sum())
        if not 0 < ones < n:
            self.b = float(np.log((ones + 0.5) / (n - ones + 0.5)))
            return self
        there, all_rows = np.bincount(flat, y[rows], len(self.w)), np.bincount(flat, minlength=len(self.w))
        ratio = np.log((there + 1) / (ones + 2)) - np.log((all_rows - there + 1) / (n - ones + 2))
        p = [np.zeros(len(self.w)), self.d, np.zeros(1)]
        first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
        for t in range(1, rounds + 1):
            self.w, self.b = p[0] * ratio, float(p[2][0])
            e = (logistic(self.margin(flat, rows, dense, n)) - y) / n
            grads = [ratio * np.bincount(flat, e[rows], len(self.w)) + decay * p[0], e @ dense + decay * p[1], np.array([e.sum()])]
            for x, g, m, v in zip(p, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        self.w, self.b = p[0] * ratio, float(p[2][0])
        return self


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Chain:
    """Linear models in sequence; .vocabulary holds the sorted hashes of the words they know."""

    def __init__(self, names: tuple[str, ...]):
        self.names, self.models, self.vocabulary = names, [], np.zeros(0, np.uint64)

    def features(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, rows)."""
        if not sets or not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.searchsorted(self.vocabulary, flat)
        at[at == len(self.vocabulary)] = 0
        hit = self.vocabulary[at] == flat
        return at[hit], rows[hit]

    def fit(self, sets: list[np.ndarray], y: np.ndarray, least_docs: int = LEAST_DOCS, folds: int = FOLDS) -> Chain:
        words, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0))
        self.vocabulary = words[counts >= least_docs]
        flat, rows = self.features(sets)
        n = len(sets)
        fold = np.arange(n) % folds
        before = np.zeros((n, 0))
        for k in range(len(self.names)):
            apart = np.zeros(n)
            for f in range(folds if n >= folds else 0):
                train, test = fold != f, fold == f
                place = np.cumsum(train) - 1
                own = train[rows]
                model = Linear(len(self.vocabulary), k).fit(flat[own], place[rows[own]], before[train], y[train, k])
                apart[test] = logistic(model.margin(flat, rows, before, n))[test]
            self.models.append(Linear(len(self.vocabulary), k).fit(flat, rows, before, y[:, k]))
            before = np.column_stack([before, apart])
        return self

    def predict(self, sets: list[np.ndarray]) -> np.ndarray:
        """(texts, categories) probabilities."""
        flat, rows = self.features(sets)
        before = np.zeros((len(sets), 0))
        for model in self.models:
            before = np.column_stack([before, logistic(model.margin(flat, rows, before, len(sets)))])
        return before


def train(sample: list[tuple[bytes, list[int]]], categories: dict[str, tuple[str, int]] = CATEGORIES) -> Chain:
    y = np.array([values for _, values in sample], np.float64).reshape(len(sample), len(categories))
    return Chain(tuple(categories)).fit([np.frombuffer(words, np.uint64) for words, _ in sample], y)


def _predict(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                probs = np.round(chain.predict([words_of(t) for t in part["text"].to_pylist()]), 6)
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(probs[:, k]) for k in range(len(chain.names)))], names=["doc_id", *chain.names])

    return run


def toxicity(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id and one probability per category: one row per document, no shuffle."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(lean("toxicity", _predict(chain), power_tables.clear), "doc_id long, " + ", ".join(f"{n} double" for n in chain.names))


def is_toxic(threshold: float = 0.3) -> Column:
    """Toxic documents are the lesser class, whose probabilities err low: trained on three quarters of the labels of sf0.1, 0.3 finds 114
    of the 119 toxic documents of the last quarter and one clean one, 0.5 finds 105 and none."""
    return F.col(list(CATEGORIES)[-1]) >= threshold
