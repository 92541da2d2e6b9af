"""Token-ID files: flat unsigned integers with 64-bit document offsets, memory-mapped on reading.

A folder holds, for each part k of the ascending doc_id order,
  part-k.tokens   ids, little-endian uint16 if the vocabulary and the end id fit, else uint32
  part-k.offsets  int64, one more than documents: where each document begins in the tokens file
  part-k.docs     int64 doc_ids
and index.json with each part's counts and its base, the prefix sum of the tokens of all parts before it.

Texts are encoded by the tokenizers library. The normaliser and pre-tokeniser that KNOWN describes never join across ASCII
white space, so that under them each distinct run of other bytes is encoded once a batch and remembered (the first MEMO runs of a
worker). Runs are found by 64-bit hash and compared byte by byte; where a hash stands for two runs, the batch is encoded
text by text. Runs of letters share a call, where each must come back as one pre-token; all others are encoded alone. With
any other tokenizer each text is encoded as it is.

Every part is written under a name of its attempt and renamed when whole: a lost executor's task is simply run again.
Files are memory-mapped, so that the folder must be a mount that driver and executors share.
Defined results: null texts are empty and have the end id only; rows that repeat a doc_id, or have none, are ordered by a
hash of their texts; rows without doc_id come first, their id is null. An empty table makes an index without parts.
"""

from __future__ import annotations

import bisect
import json
import os
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import lean, small_batches, trim
from tessella.llm.shingles import power_tables, span_hashes

END_ID = 1
MEMO = 200_000
BATCH = 1 << 20
#: Documents aimed at for a part; the parts from which on parts grow instead, since the driver holds a row for each.
PART_DOCS, MOST_PARTS = 16_384, 65_536
#: Parts that one task reads, where there are more parts than cores.
PARTS_PER_TASK = 8
#: Sampled rows for each bound between parts.
BOUND_ROWS = 16
#: Normaliser, pre-tokeniser and suffix under which runs between ASCII white space are encoded apart from each other.
KNOWN = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "</w>",
)
BLANK, STOP, LETTER = (np.isin(np.arange(256), list(x)) for x in (b"\t\n\x0b\x0c\r ", b".,", b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"

_encoders: dict[tuple[str, int], Encoder] = {}


class Encoder:
    """Encodes whole texts to arrays of ids; each distinct run of a batch goes through the tokenizer once."""

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        size = max(end_id, *vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        parts = [json.loads(x.__getstate__()) if x else None for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        #: Whether runs between white space may be encoded apart.
        self.apart = (*parts, getattr(self.tokenizer.model, "end_of_word_suffix", None)) == KNOWN
        #: Ids that end a pre-token.
        self.last = np.zeros(size, bool)
        for token, k in vocabulary.items():
            self.last[k] = token.endswith("</w>")
        del vocabulary
        trim()
        # Remembered runs: sorted hashes, where their ids are in flat, and where their bytes are in raw.
        self.keys = np.zeros(0, np.uint64)
        self.at, self.size, self.raw_at, self.raw_size = (np.zeros(0, np.int32) for _ in range(4))
        self.flat, self.raw = np.zeros(0, self.dtype), np.zeros(0, np.uint8)

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs one after the other, number of ids of each)."""
        flats, sizes = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for a in range(0, len(runs), 2048):
            part = [r.decode() for r in runs[a : a + 2048]]
            words = all(map(str.isalpha, part))
            flat = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int64) if words else None
            ends = np.flatnonzero(self.last[flat]) + 1 if words else None
            if words and len(ends) == len(part):  # every run is one pre-token, as each has at least one
                flats.append(flat.astype(self.dtype))
                sizes.append(np.diff(ends, prepend=0))
            else:
                each = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                flats.append(np.array([k for ids in each for k in ids], self.dtype))
                sizes.append(np.array([len(ids) for ids in each], np.int64))
        return np.concatenate(flats), np.concatenate(sizes)

    def lookup(self, hashes: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(at, size, flat) of distinct hashes, whose runs are buffer[start:end]; None if a hash is remembered for other bytes."""
        place = np.searchsorted(self.keys, hashes)
        place[place == len(self.keys)] = 0
        hit = self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), bool)
        old = place[hit]
        if not same_runs(buffer, starts[hit], ends[hit] - starts[hit], self.raw, self.raw_at[old].astype(np.int64), self.raw_size[old].astype(np.int64)):
            return None
        new = np.flatnonzero(~hit)
        joined = buffer.tobytes()
        runs = [joined[i:j] for i, j in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
        # Words first: they share calls.
        other = np.array([not (r if r.isascii() else r.decode()).isalpha() for r in runs], bool)
        order = np.argsort(other, kind="stable")
        words = len(runs) - int(other.sum())
        new, runs = new[order], [runs[k] for k in order]
        made = [self.learn(runs[:words]), self.learn(runs[words:])]
        flat, sizes = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
        first = np.cumsum(sizes) - sizes + len(self.flat)
        at, size = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        at[hit], size[hit] = self.at[old], self.size[old]
        at[new], size[new] = first, sizes
        both = np.concatenate([self.flat, flat])
        if len(self.keys) + len(new) <= MEMO:
            lengths = ends[new] - starts[new]
            grown = [(self.at, first), (self.size, sizes), (self.raw_at, np.cumsum(lengths) - lengths + len(self.raw)), (self.raw_size, lengths)]
            keys = np.concatenate([self.keys, hashes[new]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.at, self.size, self.raw_at, self.raw_size = (np.concatenate([old, new.astype(np.int32)])[order] for old, new in grown)
            self.flat, self.raw = both, np.concatenate([self.raw, np.frombuffer(b"".join(runs), np.uint8)])
        return at, size, both

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text and the end id, in order."""
        batch: list[bytes] = []
        held = 0
        for text in texts:
            raw = text.encode() if text else b""
            if batch and held + len(raw) > BATCH:
                yield from self._encode(batch)
                batch, held = [], 0
            batch.append(raw)
            held += len(raw) + 1
        if batch:
            yield from self._encode(batch)

    def _encode(self, batch: list[bytes]) -> Iterator[bytes]:
        buffer = np.frombuffer(b"\n".join(batch), np.uint8)
        found = self._runs(buffer) if self.apart else None
        if found is None:
            for each in self.tokenizer.encode_batch_fast([raw.decode() for raw in batch], add_special_tokens=False):
                yield np.array(each.ids, self.dtype).tobytes() + self.end
            return
        starts, at, size, flat = found
        bounds = np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in batch)]))
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        ids = flat[np.repeat(at - (after - size), size) + np.arange(total)]
        cuts = np.concatenate([[0], after])[bounds].tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield ids[a:b].tobytes() + self.end

    def _runs(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(start, place in flat, number of ids, flat) of every run; None if two runs share a hash."""
        starts, ends, hashes = runs_of(buffer)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        again = np.flatnonzero(first[inverse] != np.arange(len(inverse)))
        model, sizes = first[inverse[again]], ends - starts
        if not same_runs(buffer, starts[again], sizes[again], buffer, starts[model], sizes[model]):
            return None
        told = self.lookup(distinct, buffer, starts[first], ends[first])
        return told and (starts, told[0][inverse], told[1][inverse], told[2])


def same_runs(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> bool:
    """Whether the k-th runs of both buffers are equal, for all k."""
    if not np.array_equal(a_size, b_size):
        return False
    before = np.cumsum(a_size) - a_size
    step = np.arange(int(a_size.sum()))
    return bool((a[np.repeat(a_at - before, a_size) + step] == b[np.repeat(b_at - before, a_size) + step]).all())


def runs_of(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of runs between ASCII white space. A single comma or full stop that ends a run
    after an ASCII letter is a run of its own, as it is a pre-token of its own."""
    blank = np.concatenate([[True], BLANK[buffer], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    tail = ends - 1
    apart = tail[(tail > starts) & STOP[buffer[tail]] & LETTER[buffer[tail - 1]]] if len(ends) else tail
    starts, ends = np.sort(np.concatenate([starts, apart])), np.sort(np.concatenate([ends, apart]))
    return starts, ends, span_hashes(buffer, starts, ends)


def forget() -> None:
    _encoders.clear()
    power_tables.clear()


def encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def part_bounds(docs: DataFrame) -> list[tuple[int, int]]:
    """(doc_id, hash of text) that begin the parts after the first: of a sample by hash, every so-manieth row in order.

    About BOUND_ROWS rows for each of at most MOST_PARTS parts come to the driver."""
    counted = docs.select(F.count(F.lit(1)).alias("n")).first().n
    parts = min(MOST_PARTS, -(-counted // PART_DOCS))
    if parts < 2:
        return []
    every = max(1, counted // (BOUND_ROWS * parts))
    known = docs.where("doc_id IS NOT NULL" if every > 1 else "true")
    rows = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select(_id("doc_id").alias("id"), F.xxhash64("text").alias("digest")).collect()
    rows = sorted((r.id, r.digest) for r in rows)
    return sorted({rows[k * len(rows) // parts] for k in range(1, parts)}) if rows else []


def _id(doc_id: str):
    """The id as a number that orders rows without id first."""
    return F.coalesce(doc_id, F.lit(-(1 << 63)))


def _encode(path: str, end_id: int, bounds: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path, end_id)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):  # bounds the memory beside the batch
                part = batch.slice(a, 1024)
                ids = list(made.encode(part["text"].to_pylist()))
                places = [bisect.bisect_right(bounds, row) for row in zip(part["id"].to_pylist(), part["digest"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), part["id"], part["digest"], part["doc_id"], pa.array(ids, pa.binary())], names=["part", "id", "digest", "doc_id", "ids"])

    return run


class _Part:
    """The three files of a part, under names of this attempt until close()."""

    def __init__(self, folder: str, number: int, width: int):
        self.stem, self.width, self.number = f"{folder}/part-{number:06d}", width, number
        self.attempt = uuid.uuid4().hex
        self.files = {k: open(f"{self.stem}.{k}.{self.attempt}", "wb", buffering=1 << 20) for k in ("tokens", "offsets", "docs")}
        self.files["offsets"].write(np.zeros(1, "<i8").tobytes())
        self.docs = self.tokens = self.nulls = 0

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        ends = self.tokens + np.cumsum([len(x) // self.width for x in ids])
        self.files["tokens"].write(b"".join(ids))
        self.files["offsets"].write(ends.astype("<i8").tobytes())
        self.files["docs"].write(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
        self.docs, self.tokens, self.nulls = self.docs + len(ids), int(ends[-1]), self.nulls + sum(d is None for d in doc_ids)

    def close(self) -> tuple[int, int, int, int]:
        for k, f in self.files.items():
            f.close()
            os.replace(f.name, f"{self.stem}.{k}")
        return self.number, self.docs, self.tokens, self.nulls


def _write(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Path(folder).mkdir(parents=True, exist_ok=True)
        part, done = None, []
        for batch in batches:
            numbers = batch["part"].to_numpy()
            edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if part is None or part.number != numbers[a]:
                    if part:
                        done.append(part.close())
                    part = _Part(folder, int(numbers[a]), width)
                own = batch.slice(a, b - a)
                part.add(own["doc_id"].to_pylist(), own["ids"].to_pylist())
        if part:
            done.append(part.close())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done, strict=True)] if done else [pa.array([], pa.int64())] * 4, names=["part", "docs", "tokens", "nulls"])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> dict:
    """Writes the folder and returns its index. Only ids travel between executors, and one row a part to the driver."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    small_batches(docs.sparkSession)
    bounds = part_bounds(narrow)
    made = encoder(tokenizer, end_id)
    keyed = narrow.select("doc_id", _id("doc_id").alias("id"), F.xxhash64("text").alias("digest"), "text")
    encoded = keyed.mapInArrow(lean("tokens", _encode(tokenizer, end_id, bounds), forget), "part int, id long, digest long, doc_id long, ids binary")
    ordered = encoded.repartition(len(bounds) + 1, "part").sortWithinPartitions("part", "id", "digest", "ids").select("part", "doc_id", "ids")
    rows = sorted(ordered.mapInArrow(lean("tokens", _write(folder, made.dtype.itemsize), forget), "part long, docs long, tokens long, nulls long").collect())
    bases = np.cumsum([0, *(r.tokens for r in rows)]).tolist()
    index = {"dtype": made.dtype.str, "end_id": end_id, "tokens": bases[-1], "parts": [{"part": r.part, "docs": r.docs, "tokens": r.tokens, "nulls": r.nulls, "base": base} for r, base in zip(rows, bases[:-1], strict=True)]}
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, "index.json").write_text(json.dumps(index))
    return index


def _read(folder: str, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stem = f"{folder}/part-{row['part']:06d}"
                tokens = np.memmap(f"{stem}.tokens", dtype, "r")
                offsets, docs = np.memmap(f"{stem}.offsets", "<i8", "r"), np.memmap(f"{stem}.docs", "<i8", "r")
                for a in range(0, row["docs"], 4096):
                    b = min(a + 4096, row["docs"])
                    at = offsets[a : b + 1].tolist()
                    sums = [zlib.crc32(tokens[i:j].astype("<u4").tobytes()) for i, j in zip(at[:-1], at[1:], strict=True)]
                    ids = pa.array(np.array(docs[a:b]), pa.int64(), mask=np.arange(a, b) < row["nulls"])
                    yield pa.RecordBatch.from_arrays([ids, pa.array(row["base"] + np.array(at[:-1])), pa.array(np.diff(at)), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the memory-mapped files."""
    index = json.loads(Path(folder, "index.json").read_text())
    parts = spark.createDataFrame([(p["part"], p["docs"], p["nulls"], p["base"]) for p in index["parts"]], "part long, docs long, nulls long, base long")
    # A part is read in well under a second: a task takes several, unless there are cores for all.
    n = len(index["parts"])
    spread = parts.repartition(max(1, min(n, max(spark.sparkContext.defaultParallelism, n // PARTS_PER_TASK))), "part")
    return spread.mapInArrow(lean("tokens", _read(folder, index["dtype"]), forget), ROWS)


def document_ids(folder: str, part: int, at: int) -> np.ndarray:
    """The ids of a part's at-th document, as a view of the mapped file."""
    index = json.loads(Path(folder, "index.json").read_text())
    stem = f"{folder}/part-{part:06d}"
    offsets = np.memmap(f"{stem}.offsets", "<i8", "r")
    return np.memmap(f"{stem}.tokens", index["dtype"], "r")[offsets[at] : offsets[at + 1]]
