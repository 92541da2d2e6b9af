"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

Training is backpropagation through time on segments of a bounded sample: `per_language` labelled documents of each
language (the first by hash) and of each `segments` segments of `steps` bytes, drawn at pseudorandom places of its whole
text where the text is; only segments come to the driver. Every position of a segment is labelled with the language of its document. Prediction reads every byte of every text: texts are laid out in segments of `steps` bytes,
the network labels each position, and a document's probabilities are the mean over its positions.

Defined results: `und` with score 0 if the text is null or has no letter, or if nothing could be learned; a single
learned language is predicted with score 1. Rows that repeat a doc_id, or have none, are rows of their own, and equal
texts get equal predictions; in training, rows that tie count in the order of their texts. Training never sees documents without doc_id, text or lang. lang, source
and doc_id are never inputs of a prediction. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import bounded_broadcast, cut, lean, map_rows, small_batches, trim

PER_LANGUAGE = 240
SEGMENTS = 4
STEPS = 64
HIDDEN = 8
EPOCHS = 12
#: Segments that run through the network side by side.
LANES = 2048
UND = "und"


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's digits is 0 modulo 5; a row without id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, segments: int = SEGMENTS, steps: int = STEPS) -> list[tuple[str, bytes]]:
    """(lang, segment) of at most `per_language` documents a language, `segments` of each. Only ids and languages are
    ranked first; texts are read for the chosen ids alone, and ranked once more where rows repeat an id."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("lang").alias("lang"), F.col("text").alias("text"))
    known = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.select("doc_id", "lang").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= per_language)
    ids = bounded_broadcast(cut(chosen.select("doc_id").distinct()), 16)
    drawn = known.join(ids, "doc_id", "left_semi").mapInArrow(lean("language", _segments(segments, steps)), "lang string, doc_id long, digest long, segments array<binary>")
    least = Window.partitionBy("lang").orderBy(*order, "digest")
    kept = drawn.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= per_language)
    return [(r.lang, bytes(x)) for r in kept.orderBy("lang", "doc_id", "digest").collect() for x in r.segments]


def _segments(segments: int, steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, digests = [], []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                raw = text.as_py().encode()
                digests.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True))
                rng = np.random.Generator(np.random.PCG64([doc & (1 << 63) - 1, digests[-1] & (1 << 63) - 1]))
                places = rng.integers(0, max(1, len(raw) - steps + 1), segments).tolist() if has_letter(text.as_py()) else []
                out.append([raw[at : at + steps] for at in places])
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["doc_id"].cast(pa.int64()), pa.array(digests, pa.int64()), pa.array(out, pa.list_(pa.binary()))], names=["lang", "doc_id", "digest", "segments"])

    return run


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Network:
    """Weights of both directions, and the readout of every position."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.langs, self.hidden = langs, hidden
        shape = {"E": (256, 3 * hidden), "W": (hidden, 3 * hidden), "O": (hidden, len(langs))}
        self.p = {f"{k}{d}": (rng.standard_normal(s) * (0.3 if k == "E" else 1 / np.sqrt(hidden))).astype(np.float32) for d in "fb" for k, s in shape.items()}
        self.p["b"] = np.zeros(len(langs), np.float32)

    def cell(self, d: str, h: np.ndarray, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """One step: gates z and r through tanh(x / 2), as logistic(x) = (1 + tanh(x / 2)) / 2."""
        n = self.hidden
        a = self.p["E" + d].take(x, axis=0)
        u = h @ self.p["W" + d]
        g = np.tanh((a[:, : 2 * n] + u[:, : 2 * n]) * np.float32(0.5))
        g += 1
        g *= np.float32(0.5)
        z, r = g[:, :n], g[:, n:]
        c = np.tanh(a[:, 2 * n :] + r * u[:, 2 * n :])
        if keep is not None:
            keep.append((h, z, r, c, u[:, 2 * n :].copy(), x))
        return c + z * (h - c)

    def gates(self, d: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Tables and weights of z, r and c, each contiguous, those of z and r halved for tanh(x / 2)."""
        n = self.hidden
        cut = lambda m, k: np.ascontiguousarray(m[:, k * n : (k + 1) * n] * np.float32(1 if k == 2 else 0.5))
        return [cut(self.p["E" + d], k) for k in range(3)], [cut(self.p["W" + d], k) for k in range(3)]

    def run(self, d: str, x: np.ndarray, order) -> Iterator[tuple[int, np.ndarray]]:
        """(step, state) of one direction. All arrays are whole and reused; the state is overwritten by the next step."""
        (ez, er, ec), (wz, wr, wc) = self.gates(d)
        half, one = np.float32(0.5), np.float32(1)
        h, z, r, c, u = (np.zeros((x.shape[1], self.hidden), np.float32) for _ in range(5))
        for t in order:
            for e, w, g in ((ez, wz, z), (er, wr, r)):
                e.take(x[t], axis=0, out=g, mode="clip")
                np.matmul(h, w, out=u)
                g += u
                np.tanh(g, out=g)
                g += one
                g *= half
            np.matmul(h, wc, out=u)
            u *= r
            ec.take(x[t], axis=0, out=c, mode="clip")
            c += u
            np.tanh(c, out=c)
            h -= c
            h *= z
            h += c
            yield t, h

    def positions(self, x: np.ndarray) -> np.ndarray:
        """(steps, lanes, langs) probabilities for bytes x of (steps, lanes)."""
        steps, lanes = x.shape
        logits = np.empty((steps, lanes, len(self.langs)), np.float32)
        for t, h in self.run("f", x, range(steps)):
            np.matmul(h, self.p["Of"], out=logits[t])
        ones = np.ones((len(self.langs), len(self.langs)), np.float32)
        for t, h in self.run("b", x, reversed(range(steps))):
            e = logits[t]
            e += h @ self.p["Ob"]
            e += self.p["b"]
            np.clip(e, -30, 30, out=e)
            np.exp(e, out=e)
            e /= e @ ones
        return logits

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over positions: x (steps, lanes) bytes, y (lanes) language numbers."""
        steps, lanes = x.shape
        n = self.hidden
        kept: dict[str, list] = {"f": [], "b": []}
        states = {}
        for d, order in (("f", range(steps)), ("b", reversed(range(steps)))):
            h, states[d] = np.zeros((lanes, n), np.float32), [None] * steps
            for t in order:
                h = self.cell(d, h, x[t], kept[d])
                states[d][t] = h
        f, b = np.stack(states["f"]), np.stack(states["b"])
        logits = f @ self.p["Of"] + b @ self.p["Ob"] + self.p["b"]
        logits -= logits.max(axis=2, keepdims=True)
        e = np.exp(logits)
        e /= e.sum(axis=2, keepdims=True)
        e[:, np.arange(lanes), y] -= 1
        e /= steps * lanes
        grads = {"b": e.sum(axis=(0, 1)), "Of": np.einsum("tln,tlc->nc", f, e), "Ob": np.einsum("tln,tlc->nc", b, e)}
        for d, order in (("f", reversed(range(steps))), ("b", range(steps))):
            gE, gW = np.zeros_like(self.p["E" + d]), np.zeros_like(self.p["W" + d])
            dh = np.zeros((lanes, n), np.float32)
            for t, saved in zip(order, reversed(kept[d]), strict=True):
                h, z, r, c, uc, xt = saved
                dh = dh + e[t] @ self.p["O" + d].T
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (h - c) * z * (1 - z)
                dr = dc * uc * r * (1 - r)
                da = np.concatenate([dz, dr, dc], axis=1)
                du = np.concatenate([dz, dr, dc * r], axis=1)
                np.add.at(gE, xt, da)
                gW += h.T @ du
                dh = dh * z + du @ self.p["W" + d].T
            grads["E" + d], grads["W" + d] = gE, gW
        return grads


def train(sample: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = STEPS, epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Adam on shuffled batches of segments; the same sample gives the same weights. A segment of a shorter text is repeated."""
    usable = [(lang, piece) for lang, piece in sample if piece]
    net = Network(sorted({lang for lang, _ in usable}), hidden)
    if len(net.langs) < 2:
        return net
    rng = np.random.Generator(np.random.PCG64(seed))
    x = np.stack([np.frombuffer((piece * (steps // len(piece) + 1))[:steps], np.uint8) for _, piece in usable])
    y = np.array([net.langs.index(lang) for lang, _ in usable])
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    tick = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = 0.02 * (1 - epoch / epochs) + 0.002
        for at in range(0, len(order), 256):
            pick = order[at : at + 256]
            grads = net.gradients(x[pick].T.astype(np.intp), y[pick])
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            tick += 1
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / (size + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                net.p[k] -= (rate * (first[k] / (1 - 0.9**tick)) / (np.sqrt(second[k] / (1 - 0.99**tick)) + 1e-7)).astype(np.float32)
    trim()
    return net


def document_probabilities(net: Network, raws: list[bytes], steps: int = STEPS) -> np.ndarray:
    """(documents, langs): the mean over all positions of each text. Every text must have a byte."""
    sizes = np.array([len(r) for r in raws], np.int64)
    lanes_of = -(-sizes // steps)
    total = int(lanes_of.sum())
    last = np.cumsum(lanes_of)
    padded = np.zeros(total * steps, np.uint8)
    valid = np.full(total, steps, np.int64)
    for raw, end, n in zip(raws, last.tolist(), lanes_of.tolist(), strict=True):
        at = (end - n) * steps
        padded[at : at + len(raw)] = np.frombuffer(raw, np.uint8)
        valid[end - 1] = len(raw) - (n - 1) * steps
    grid = padded.reshape(total, steps)
    sums = np.zeros((total, len(net.langs)), np.float64)
    for a in range(0, total, LANES):
        probs = net.positions(np.ascontiguousarray(grid[a : a + LANES].T).astype(np.intp))
        whole = probs.sum(axis=0, dtype=np.float64)
        for k in np.flatnonzero(valid[a : a + LANES] < steps).tolist():
            whole[k] = probs[: valid[a + k], k].sum(axis=0, dtype=np.float64)
        sums[a : a + LANES] = whole
    return np.add.reduceat(sums, last - lanes_of, axis=0) / sizes[:, None]


def _predict(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            langs, scores = [UND] * len(texts), [0.0] * len(texts)
            at = [k for k, text in enumerate(texts) if net.langs and has_letter(text)]
            if len(net.langs) == 1:
                for k in at:
                    langs[k], scores[k] = net.langs[0], 1.0
            else:
                for a in range(0, len(at), 512):
                    part = at[a : a + 512]
                    probs = document_probabilities(net, [texts[k].encode() for k in part])
                    for k, row in zip(part, probs, strict=True):
                        best = int(row.argmax())
                        langs[k], scores[k] = net.langs[best], round(float(min(1.0, row[best])), 4)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "text", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, net: Network, text_too: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score (and text): one row per document."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    out = rows.mapInArrow(lean("language", _predict(net)), "doc_id long, text string, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", *["text"] * text_too)


def keep_identified(docs: DataFrame, net: Network, least: float) -> DataFrame:
    """The rows of docs, all columns, whose text is identified with a score of at least `least`."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _predict(net)
        for batch in batches:
            thin = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)], names=["doc_id", "text"])
            (said,) = predict(iter([thin]))
            keep = pa.array([lang != UND and score >= least for lang, score in zip(said["lang_pred"].to_pylist(), said["score"].to_pylist(), strict=True)], pa.bool_())
            yield batch.filter(keep)

    return map_rows(docs, lean("language", run), docs.schema)
