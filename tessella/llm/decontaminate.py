"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z is lower-cased. A window is `window` consecutive words of an
item, or all its words if it has fewer. Items and texts are normalised to single blanks between words, with a blank at
both ends, so that an occurrence is a whole run of words; each text is scanned once and offsets come back through the
word spans of the original.

The automaton holds, of each item, every stride-th run of `stride` = (window + 1) div 2 words: any window has one such run whole.
A run that occurs is extended word by word, at most window - stride words to either side, and counts if it is part of a whole
window. So each word of an item is in the automaton once and not in `window` patterns.

There is one automaton, whatever the benchmark's size. The items are written to the shared folder as one file, part by
part through the driver, which holds no more than a partition of them; each Python worker builds the automaton from it
once. It takes about 50 bytes of a worker's memory for each byte of items (47 over 5 MB of random items).

Defined results: a null text has no words; an item without words or without id has no windows; items that share an
id are one item; an empty benchmark hits nothing; rows that repeat a doc_id, or have none, are rows of their own; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import lean, map_rows, shared_path, small_batches

WINDOW = 13
KEEP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
RESULT = "doc_id long, n_words long, n_hit long, items array<string>, items_sha256 string, hit_spans array<struct<start: long, end: long>>"

#: The automaton of this worker process, by the name of its file.
_built: dict[tuple[str, int], Items] = {}


def normalise(text: str | None) -> list[bytes]:
    return text.encode().lower().translate(KEEP).split() if text else []


class Items:
    """The automaton and what belongs to its patterns: (item, place of the pattern in it)."""

    def __init__(self, rows: Iterator[tuple[str, list[bytes]]], window: int = WINDOW):
        import ahocorasick

        self.window, self.stride = window, (window + 1) // 2
        self.names: list[str] = []
        self.words: list[list[bytes]] = []
        self.owners: list[list[tuple[int, int]]] = []
        numbers: dict[bytes, int] = {}
        known: dict[bytes, bytes] = {}
        self.made = ahocorasick.Automaton()
        for name, raw in rows:
            words = [known.setdefault(w, w) for w in raw]  # one object for each distinct word
            if not words:
                continue
            item = len(self.names)
            self.names.append(name)
            self.words.append(words)
            whole = len(words) < window
            for at in [0] if whole else range(0, len(words) - self.stride + 1, self.stride):
                part = b" ".join(words if whole else words[at : at + self.stride])
                if part not in numbers:
                    numbers[part] = len(self.owners)
                    self.owners.append([])
                    self.made.add_word(f" {part.decode()} ", numbers[part])
                self.owners[numbers[part]].append((item, at))
        if self.owners:
            self.made.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str], bool]:
        """Word spans [start, end) that windows cover, merged; the items they belong to; whether a window of full length is one."""
        found: list[tuple[int, int]] = []
        items: set[str] = set()
        full = False
        if not self.owners or not words:
            return np.zeros((0, 2), np.int32), items, full
        norm = f" {b' '.join(words).decode()} "
        matches = list(self.made.iter(norm))
        if not matches:
            return np.zeros((0, 2), np.int32), items, full
        blanks = np.cumsum([0, *(len(w.decode()) + 1 for w in words)])  # offset of the blank that follows the k-th word
        lasts = np.searchsorted(blanks, [end for end, _ in matches]).tolist()
        reach = self.window - self.stride
        for last, (_, number) in zip(lasts, matches, strict=True):
            for item, at in self.owners[number]:
                own = self.words[item]
                if len(own) < self.window:
                    found.append((last - len(own), last))
                    items.add(self.names[item])
                    continue
                first, low, high = last - self.stride, 0, 0
                while low < reach and first > low and at > low and words[first - low - 1] == own[at - low - 1]:
                    low += 1
                after = at + self.stride
                while high < reach and last + high < len(words) and after + high < len(own) and words[last + high] == own[after + high]:
                    high += 1
                if low + high >= reach:
                    found.append((first - low, last + high))
                    items.add(self.names[item])
                    full = True
        return merged(np.array(found, np.int32).reshape(-1, 2)), items, full


def merged(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans that cover the same words."""
    if len(spans) == 0:
        return spans.astype(np.int32)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    at = np.flatnonzero(first)
    return np.stack([spans[at, 0], np.maximum.reduceat(spans[:, 1], at)], axis=1).astype(np.int32)


def write_items(benchmark: DataFrame) -> str:
    """The items as lines of id and normalised words in a file of the shared folder, in an order that doesn't depend on partitions."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    path = shared_path(benchmark.sparkSession, "items")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        for row in rows.orderBy("item", "text").toLocalIterator():
            out.write(row.item.encode().hex().encode() + b"\t" + b" ".join(normalise(row.text)) + b"\n")
    return path


def read_items(path: str) -> Iterator[tuple[str, list[bytes]]]:
    with open(path, "rb") as lines:
        for line in lines:
            item, words = line.split(b"\t")
            yield bytes.fromhex(item.decode()).decode(), words.split()


def built(path: str, window: int) -> Items:
    if (path, window) not in _built:
        _built.clear()
        _built[path, window] = Items(read_items(path), window)
    return _built[path, window]


def original_spans(text: str, spans: np.ndarray) -> list[tuple[int, int]]:
    """Code point offsets in the original text of merged word spans."""
    at = [m.span() for m in WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in spans.tolist()]


def _scanner(path: str, window: int):
    place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = built(path, window)
        for batch in batches:
            counts, hits, names, digests, places = [], [], [], [], []
            for cell in batch["text"]:
                text = cell.as_py()
                words = normalise(text)
                spans, own, _ = items.scan(words)
                counts.append(len(words))
                hits.append(int((spans[:, 1] - spans[:, 0]).sum()))
                names.append(sorted(own))
                digests.append(hashlib.sha256(",".join(names[-1]).encode()).hexdigest())
                places.append([{"start": a, "end": b} for a, b in original_spans(text, spans)] if len(spans) else [])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(digests, pa.string()), pa.array(places, place)],
                names=["doc_id", "n_words", "n_hit", "items", "items_sha256", "hit_spans"],
            )

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items, items_sha256, hit_spans (code points of the original text): one row per document."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(lean("decontaminate", _scanner(write_items(benchmark), window), _built.clear), RESULT)


def is_contaminated(percent: int = 5):
    """n_hit > 0, and at least `percent` of the words are hit."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """The rows of docs, all columns, that hold no window of full length, and of whose words less than `percent` lie in
    shorter items. Rows are decided on where they are: nothing is shuffled or joined."""
    small_batches(docs.sparkSession)
    path = write_items(benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = built(path, window)
        for batch in batches:
            keep = []
            for cell in batch.column(at):
                words = normalise(cell.as_py())
                spans, _, full = items.scan(words)
                hit = int((spans[:, 1] - spans[:, 0]).sum())
                keep.append(not full and (hit == 0 or 100 * hit < percent * len(words)))
            yield batch.filter(pa.array(keep, pa.bool_()))

    at = docs.columns.index("text")
    return map_rows(docs, lean("decontaminate", run, _built.clear), docs.schema)
