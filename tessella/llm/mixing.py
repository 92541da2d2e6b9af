"""Mixing sources to target weights, in blocks drawn by index.

Each source's words, document after document in a pseudorandom but fixed order, are packed into blocks of
`block_words`. Output shards draw multinomial counts of slots for the sources, each with what earlier shards left of
the targets as probabilities, so that totals end at the targets. A source's slots are numbered on through all shards;
slot j takes, in its pass j div n, the block that the source's permutation for that pass gives for j mod n. Slots and blocks
are joined by (source, block); a block holds at most `block_words` pieces of documents, so that no key is hot.

A document's place in its source comes from prefix sums in two levels: over hash buckets of a source, then inside a
bucket, so that a source with a third of all rows is still spread over its buckets, of which there are more the more
rows there are. Only per-source totals come to the driver; they are broadcast if they are proven to be small.

Defined results: null texts have size 0 and are never taken; a null source is a source of its own, ordered last; rows
that share a doc_id or have none are ordered by a hash of their texts, and rows that also share text and source are
interchangeable; an empty table gives no rows; other columns may have any names. Reruns take the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import BROADCAST_BYTES, cut, free_name, lean, map_rows, quoted, small_batches

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_WORDS = 64
#: Output shards, and the slots of one beyond which there are more of them.
SHARDS, SHARD_SLOTS, MOST_SHARDS = 64, 1 << 22, 4096
#: Hash buckets of a source at least, and the rows aimed at for one.
BUCKETS, BUCKET_ROWS = 256, 1 << 20
WORDS = r"[^\x20\x09-\x0D]+"
#: Slots of one row before they are spread, and rows of a task that spreads them.
CHUNK, CHUNKS_PER_TASK = 4096, 16


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, digest: a hash of the text, which tells rows without a doc_id of their own apart."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"), F.col("text").alias("text"))
    return narrow.select("doc_id", "source", words_in(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"))


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_totals(sizes: DataFrame) -> tuple[list[tuple[str | None, int]], int]:
    """((source, words), by code point, null last; number of documents): one row a source comes to the driver."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).collect()
    return sorted([(r.source, r.words) for r in rows], key=lambda r: (r[0] is None, r[0] or "")), sum(r.n for r in rows)


def targets(totals: list[int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST_PASSES) -> list[float]:
    """Shares of all words by weight, held at `most` times a source's words; the excess is reshared until none is above."""
    n = len(totals)
    weight = [float(weights[k % len(weights)]) for k in range(n)]
    limit = [most * float(t) for t in totals]
    out, held = [0.0] * n, [False] * n
    while True:
        left = float(sum(totals)) - sum(limit[k] for k in range(n) if held[k])
        sharing = sum(weight[k] for k in range(n) if not held[k])
        out = [limit[k] if held[k] else left * weight[k] / sharing for k in range(n)]
        above = [k for k in range(n) if not held[k] and out[k] > limit[k]]
        if not above:
            return out
        for k in above:
            held[k] = True


def draw(expected: np.ndarray, most: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources) slot counts: multinomial draws over what is left of the expected slots, never above `most` in all."""
    rng = np.random.Generator(np.random.PCG64(seed))
    slots = int(round(float(expected.sum())))
    counts = np.zeros((shards, len(expected)), np.int64)
    for shard in range(shards):
        size = slots * (shard + 1) // shards - slots * shard // shards
        while size:
            drawn = counts.sum(axis=0)
            left = np.where(drawn < most, np.maximum(expected - drawn, 0), 0)
            if left.sum() < 1e-9:
                break
            got = np.minimum(rng.multinomial(size, left / left.sum()), most - drawn)
            counts[shard] += got
            size -= int(got.sum())
    return counts


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of [0, n) at `index`: a Feistel network on the next power of four, walked into range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        a, b = x >> np.uint64(half), x & low
        for r in range(6):
            m = (b + np.uint64((key * 6 + r + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
            m = (m ^ (m >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            a, b = b, a ^ ((m ^ (m >> np.uint64(29))) & low)
        out[todo] = (a << np.uint64(half)) | b
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def placed(sizes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """sizes with `at`, the number of words before the document in its source."""
    keyed = sizes.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    base = sums.withColumn("base", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id", "digest", "size").rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    near = base.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base")
    joined = local.join(near.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.select("doc_id", "source", "size", "digest", (F.col("base") + F.col("local")).alias("at"))


def _slots(blocks: list[int], seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, slot = batch["number"].to_numpy(), batch["slot"].to_numpy()
            block = np.empty(len(slot), np.int64)
            size = np.array(blocks, np.int64)[source]
            turn = slot // size
            for s in np.unique(source).tolist():
                for p in np.unique(turn[source == s]).tolist():
                    own = (source == s) & (turn == p)
                    block[own] = permuted(slot[own] % blocks[s], blocks[s], seed + s * 16 + p)
            yield pa.RecordBatch.from_arrays([batch["shard"], batch["number"], batch["slot"], pa.array(block), pa.array(turn, pa.int64())], names=["shard", "number", "slot", "block", "turn"])

    return run


class Mix:
    """The plan of a mix: per-source totals, targets and slot counts; its relations are lazy."""

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, shards: int | None = None, seed: int = 17, most: int = MOST_PASSES):
        self.spark: SparkSession = docs.sparkSession
        small_batches(self.spark)
        self.block_words, self.seed = block_words, seed
        self.sizes = cut(sized(docs))  # no texts in it; every relation below starts here
        named, self.documents_in = source_totals(self.sizes)
        self.names, self.totals = [s for s, _ in named], [n for _, n in named]
        self.targets = targets(self.totals, weights, most) if named else []
        self.blocks = [-(-n // block_words) for n in self.totals]
        mean = [n / b if b else 0.0 for n, b in zip(self.totals, self.blocks, strict=True)]
        expected = np.array([t / m if m else 0.0 for t, m in zip(self.targets, mean, strict=True)])
        shards = shards or min(MOST_SHARDS, max(SHARDS, int(expected.sum()) // SHARD_SLOTS))
        self.counts = draw(expected, np.array([most * b for b in self.blocks], np.int64), shards, seed)

    def sources(self) -> DataFrame:
        """(source, number, source_size, target), with a broadcast hint if there are few enough."""
        rows = [(name, k, self.totals[k], self.targets[k]) for k, name in enumerate(self.names)]
        made = self.spark.createDataFrame(rows, "source string, number int, source_size long, target double")
        return F.broadcast(made) if sum(64 + len(name or "") for name in self.names) <= BROADCAST_BYTES else made

    def slots(self) -> DataFrame:
        """(shard, number, slot, block, turn): which block each slot of each shard takes."""
        first = np.cumsum(self.counts, axis=0) - self.counts
        rows = [(d, s, int(first[d, s]), int(self.counts[d, s])) for d in range(len(self.counts)) for s in range(len(self.names)) if self.counts[d, s]]
        cells = self.spark.createDataFrame(rows, "shard int, number int, first long, slots long")
        # Counted tasks: these rows are few and small before they are exploded, so that sizes would put them in one.
        chunks = -(-int(self.counts.sum()) // CHUNK) + len(rows)
        tasks = max(1, min(chunks, max(self.spark.sparkContext.defaultParallelism, -(-chunks // CHUNKS_PER_TASK))))
        split = cells.repartition(max(1, min(len(rows), tasks)), "shard", "number").select("shard", "number", "first", "slots", F.explode(F.sequence(F.lit(0), F.expr(f"(slots - 1) div {CHUNK}"))).alias("chunk"))
        chunks = split.repartition(tasks, "shard", "number", "chunk")
        low = F.col("first") + F.col("chunk") * CHUNK
        high = F.least(low + CHUNK, F.col("first") + F.col("slots")) - 1
        each = chunks.select("shard", "number", F.explode(F.sequence(low, high)).alias("slot"))
        return each.mapInArrow(lean("mixing", _slots(self.blocks, self.seed)), "shard int, number int, slot long, block long, turn long")

    def documents(self) -> DataFrame:
        """(doc_id, source, size, at, number, source_size, target)."""
        named = self.sources().withColumnRenamed("source", "name")
        buckets = max(BUCKETS, -(-self.documents_in // BUCKET_ROWS))
        return placed(self.sizes, buckets).join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")

    def pieces(self, documents: DataFrame) -> DataFrame:
        """(number, at, size, doc_id, block, skip, words): the words [skip, skip + words) of a document that lie in a block."""
        w = self.block_words
        split = documents.where("size > 0").select("number", "at", "size", "doc_id", "digest", F.explode(F.sequence(F.expr(f"at div {w}"), F.expr(f"(at + size - 1) div {w}"))).alias("block"))
        skip = F.greatest(F.lit(0), F.col("block") * w - F.col("at"))
        return split.select("number", "at", "size", "doc_id", "digest", "block", skip.alias("skip"), (F.least(F.col("size"), (F.col("block") + 1) * w - F.col("at")) - skip).alias("words"))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken: one row per document."""
        documents = self.documents()
        # Slots grow with the corpus, which estimates of exploded rows don't show: never broadcast.
        uses = self.slots().groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
        words = self.pieces(documents).join(uses.hint("merge"), ["number", "block"]).groupBy("number", "at").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        # (number, at) is one document: positions differ between documents that have words.
        had = documents.where("size > 0").join(words.hint("merge"), ["number", "at"], "left")
        none = documents.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
        every = had.select(*none.columns).unionByName(none)
        return every.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def rows(self, docs: DataFrame) -> DataFrame:
        """The mix as rows with the columns of docs: for each pass a document has words in, those words.

        A document that a pass takes whole keeps its text; of others the taken runs of blocks stay, each with its own
        white space, joined by a line feed. n_chars, if there is one, follows the text.
        """
        held = self.pieces(self.documents().where("size > 0")).join(self.slots().select("number", "block", "turn").hint("merge"), ["number", "block"])
        runs = held.groupBy("number", "at", "size", "doc_id", "digest", "turn").agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("skip", "words"))).alias("runs"))
        plan = runs.groupBy("number", "at", "size", "doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("turn", "words", "runs"))).alias("takes"))
        plan = plan.join(self.sources().select("number", "source"), "number")
        key, size, copies, copy, mine = (free_name(docs, n) for n in ("_key", "_size", "_copies", "_copy", "_takes"))
        # Only rows that repeat id, source and text share a key; they are interchangeable, and told apart by any order.
        # Texts move once: the numbering and the join want the same partitioning.
        wanted = plan.groupBy(_key("doc_id", "source", "digest").alias(key)).agg(F.sort_array(F.collect_list(F.struct("at", "takes"))).alias(copies))
        names = [F.col(quoted(c)) for c in docs.columns]
        counted = docs.withColumn(size, words_in(F.col("text"))).where(F.col(size) > 0).withColumn(key, _key(F.col("doc_id").cast("long"), "source", F.xxhash64("text")))
        counted = counted.withColumn(copy, F.row_number().over(Window.partitionBy(key).orderBy(size)))
        takes = F.try_element_at(copies, F.col(copy))["takes"].alias(mine)
        placed_rows = counted.join(wanted.hint("merge"), key).select(*names, size, takes).where(F.col(mine).isNotNull())
        return map_rows(placed_rows, lean("mixing", _texts(docs.columns)), docs.schema)


def _key(doc_id: str | Column, source: str, digest: str | Column) -> Column:
    known = lambda c: F.coalesce(F.concat(F.lit("="), (F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat_ws(":", known(doc_id), known(digest), known(source))))


def _texts(names: list[str]):
    import re

    word = re.compile(r"[^\x20\x09-\x0D]+")

    def cut(text: str, size: int, takes: list[dict]) -> list[str]:
        spans = None
        out = []
        for take in takes:
            if take["words"] == size:
                out.append(text)
                continue
            spans = spans or [m.span() for m in word.finditer(text)]
            joined: list[list[int]] = []
            for run in take["runs"]:
                a, b = run["skip"], run["skip"] + run["words"]
                if joined and joined[-1][1] == a:
                    joined[-1][1] = b
                else:
                    joined.append([a, b])
            out.append("\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in joined))
        return out

    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, texts = [], []
            for k, (text, size, takes) in enumerate(zip(batch.column(text_at), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True)):
                for made in cut(text.as_py(), size, takes):
                    source.append(k)
                    texts.append(made)
            place = pa.array(source, pa.int64())
            columns = [pa.array(texts, pa.string()) if k == text_at else batch.column(k).take(place) for k in range(len(names))]
            if chars_at is not None:
                columns[chars_at] = pa.array([len(t) for t in texts], pa.int64()).cast(batch.column(chars_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(names))])

    return run
