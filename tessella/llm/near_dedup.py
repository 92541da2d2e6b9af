"""Near-duplicate groups: circulant MinHash, banding, and exact Jaccard verification on full shingle sets.

Two permutations make all signature coordinates: sigma scatters the shingles over [0, D), and coordinate k is the
least pi[(sigma(x) + k) mod D], pi shifted circularly by k.

1. One scan turns each text into (set size, 128-bit digest of the set, signature bytes, band keys); texts don't travel.
2. Texts with equal sets form a class; only one row of a class goes on, so copies cost nothing further.
3. Star pass: in each band bucket every class is a candidate of the smallest class there. Candidates pass a signature
   estimate that a true link fails with a chance under 1e-8, then whole sets are compared.
4. Rest pass: buckets that still hold several components are searched in full, in blocks of bounded size, for pairs
   of different components that pass the same estimate; these are verified too. No bucket is capped.
5. Components; the smallest doc_id of a component names it.

Verification re-reads the texts of candidates only: pairs are joined to documents by a size-checked broadcast, or a
shuffled join beyond it. The smaller class of a pair is the hub; its other ends are shared out to as many tasks as it
has STAR_LEAVES of them, and compared one at a time against the hub's set. No join has a hot key: rows of a hub or
a bucket of any size meet what belongs to it over salts, or by a broadcast of the few that are that large.

The rest pass compares signatures within blocks of a bucket, so it is quadratic in the members of a bucket that stars
left with several components: documents of one family just under the threshold. Nothing but signatures of 100
bytes travels for that, and only pairs of different components that pass the estimate are verified.

Defined results: without words or text a set is empty (n_shingles 0) and linked with nothing. doc_id should be
unique; rows that repeat it with other texts are told apart by their sets. A row without doc_id links like any other,
but can't name its component: component_id is null if the whole component has none. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import BROADCAST_BYTES, bounded_broadcast, cut, join_groups, lean, small_batches, with_group_values
from tessella.llm.components import components
from tessella.llm.shingles import mix, overlap, power_tables, shingle_sets

BANDS, ROWS = 25, 4
DIMENSION = 1 << 20
#: Share of equal signature bytes below which a pair isn't compared. At a similarity of 0.8 and 100 coordinates it is 6 deviations off.
ESTIMATE = 0.55
BLOCK = 1024
STAR_SALTS = 32
#: Leaves of a hub that one task compares.
STAR_LEAVES = 2048
_FEATURES = "doc_id long, place long, n_shingles long, class binary, sig binary, bands array<long>"

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def forget() -> None:
    _tables.clear()
    power_tables.clear()


def permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """sigma, and pi followed by its own beginning, so that a shift is a view."""
    if coordinates not in _tables:
        rng = np.random.Generator(np.random.PCG64(7919))
        sigma = rng.permutation(DIMENSION).astype(np.uint32)
        pi = rng.permutation(DIMENSION).astype(np.uint32)
        _tables[coordinates] = sigma, np.concatenate([pi, pi[:coordinates]])
    return _tables[coordinates]


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(sets, coordinates) of circulant MinHash values. Sets must not be empty."""
    sigma, pi = permutations(coordinates)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    at = sigma[(np.concatenate(sets) & np.uint64(DIMENSION - 1)).astype(np.int64)].astype(np.int64)
    out = np.empty((len(sets), coordinates), np.uint32)
    for k in range(coordinates):
        out[:, k] = np.minimum.reduceat(pi[k:].take(at), starts)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) of 64-bit keys that also hold the band's number."""
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), 1))
    cells = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    for r in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, r])
    return keys.view(np.int64)


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _features(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            sizes, digests, sigs, keys = [], [], [], []
            group: list[np.ndarray] = []

            def flush() -> None:
                full = [s for s in group if len(s)]
                made = signatures(full, bands * rows) if full else np.zeros((0, bands * rows), np.uint32)
                lanes = band_keys(made, bands, rows)
                small = (made & 0xFF).astype(np.uint8)
                at = iter(range(len(full)))
                for s in group:
                    sizes.append(len(s))
                    k = next(at) if len(s) else None
                    digests.append(digest(s) if len(s) else None)
                    sigs.append(None if k is None else small[k].tobytes())
                    keys.append(None if k is None else lanes[k])
                group.clear()

            held = 0
            for found in shingle_sets(texts, width):
                group.append(found)
                held += len(found)
                if held > 1 << 17:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["place"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "place", "n_shingles", "class", "sig", "bands"],
            )

    return run


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, place, text. Texts are found again by place: the doc_id, or a hash of the text of a row without one. Rows
    of other sets at the same place are told apart by their digests, as those that repeat a doc_id are."""
    place = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), place.alias("place"), F.col("text").alias("text"))


def features(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    narrow = placed(docs)
    return narrow.mapInArrow(lean("near", _features(width, bands, rows), forget), _FEATURES)


def _compare(width: int, percent: int):
    """Rows of (hub, salt), the hub itself first: emits (hub, leaf) where 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hub = None, None
        for batch in batches:
            us, vs = [], []
            owns = batch["own"].to_pylist()
            for group, own, leaf, found in zip(zip(batch["hub"].to_pylist(), batch["salt"].to_pylist(), strict=True), owns, batch["leaf"].to_pylist(), shingle_sets(batch["text"].to_pylist(), width), strict=True):
                if group != key:
                    key, hub = group, None
                if digest(found) != leaf:
                    continue  # another text under the same doc_id
                if own:
                    hub = found
                elif hub is not None:
                    both = overlap(hub, found)
                    if 100 * both >= percent * (len(hub) + len(found) - both):
                        us.append(group[0])
                        vs.append(leaf)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])

    return run


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (hub, hub_doc, leaf, leaf_doc) that are links, as edges (u, v). pairs should be cut."""
    texts = placed(docs).select(F.col("place").alias("doc_id"), "text")
    # Hubs of more leaves than one task compares are so few that they fit a broadcast.
    most = max(STAR_LEAVES, -(-pairs.count() * 48 // BROADCAST_BYTES))
    wide = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(most))).alias("tasks")).where("tasks > 1")
    salt = F.coalesce(F.pmod(F.xxhash64("leaf"), F.col("tasks")), F.lit(0)).cast("int").alias("salt")
    salted = pairs.join(F.broadcast(cut(wide)), "hub", "left").select("hub", "hub_doc", salt, "leaf", "leaf_doc")
    leaves = salted.select("hub", "salt", F.lit(False).alias("own"), "leaf", F.col("leaf_doc").alias("doc_id"))
    hubs = salted.select("hub", "salt", F.lit(True).alias("own"), F.col("hub").alias("leaf"), F.col("hub_doc").alias("doc_id")).distinct()
    wanted = bounded_broadcast(cut(leaves.unionByName(hubs)), 64)
    rows = texts.join(wanted, "doc_id").select("hub", "salt", "own", "leaf", "text")
    spread = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.desc("own"))
    return spread.mapInArrow(lean("near", _compare(width, percent), forget), "u binary, v binary").distinct()


def _block_pairs(coordinates: int, percent: int):
    """Rows of a block pair of a bucket: emits pairs of different components whose signatures and sizes allow a link."""
    least = ESTIMATE * coordinates
    names = ["hub", "hub_doc", "leaf", "leaf_doc"]

    def search(rows: list[tuple]) -> pa.RecordBatch:
        left = [r for r in rows if r[1]]
        right = [r for r in rows if r[2]]
        out: list[list] = [[], [], [], []]
        sig = np.frombuffer(b"".join(r[7] for r in right), np.uint8).reshape(len(right), coordinates)
        roots = np.array([r[6] for r in right], object)
        sizes = np.array([r[5] for r in right], np.int64)
        for r in left:
            own = np.frombuffer(r[7], np.uint8)
            small, large = np.minimum(sizes, r[5]), np.maximum(sizes, r[5])
            fits = np.flatnonzero((100 * small >= percent * large) & (roots != r[6]))
            for k in fits[(sig[fits] == own).sum(axis=1) >= least].tolist():
                a, b = sorted([(r[3], r[4]), (right[k][3], right[k][4])])
                for cell, x in zip(out, (*a, *b), strict=True):
                    cell.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.int64()) * 2, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            cells = [batch[c].to_pylist() for c in ("key", "at_left", "at_right", "class", "doc", "n_shingles", "root", "sig")]
            for row in zip(*cells, strict=True):
                if row[0] != key:
                    if rows:
                        yield search(rows)
                    key, rows = row[0], []
                rows.append(row)
        if rows:
            yield search(rows)

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, class, component_id, kept: one row per input row."""
    small_batches(docs.sparkSession)
    facts = cut(features(docs, width, bands, rows))
    full = facts.where("n_shingles > 0")
    named = with_group_values(full, ["class"], F.xxhash64("doc_id"), [F.min("doc_id").alias("first"), F.min("place").alias("at")], [F.min("first").alias("first"), F.min("at").alias("at")])
    # One row per class: its smallest doc_id, or the smallest place of a class without ids.
    reps = named.where("place = coalesce(first, at)").select("class", F.col("place").alias("doc"), "first", "n_shingles", "sig", "bands").dropDuplicates(["class"])
    reps = cut(reps)
    lanes = reps.select(F.explode("bands").alias("band"), "class", "doc", "n_shingles")
    # Map-side combination leaves one row per task for a hot bucket.
    buckets = lanes.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("doc", "class")).alias("hub")).where("members > 1")
    hubs = cut(buckets.select("band", "members", F.col("hub.doc").alias("hub_doc"), F.col("hub.class").alias("hub")))
    members = cut(join_groups(lanes, hubs, "band", "members", 96))
    star = members.where("class <> hub").select("hub", "hub_doc", F.col("class").alias("leaf"), F.col("doc").alias("leaf_doc"), F.pmod(F.xxhash64("class"), F.lit(STAR_SALTS)).cast("int").alias("salt")).distinct()
    sigs = reps.select("class", "n_shingles", "sig").dropDuplicates(["class"])
    # A hub's signature comes to its leaves once for each salt.
    left = star.select("hub", "salt").distinct().join(sigs.select(F.col("class").alias("hub"), F.col("n_shingles").alias("n1"), F.col("sig").alias("s1")), "hub")
    right = sigs.select(F.col("class").alias("leaf"), F.col("n_shingles").alias("n2"), F.col("sig").alias("s2"))
    sized = star.join(left, ["hub", "salt"]).join(right, "leaf").where(F.expr(f"100 * least(n1, n2) >= {percent} * greatest(n1, n2)"))
    likely = sized.mapInArrow(lean("near", _estimate(bands * rows), forget), "hub binary, hub_doc long, leaf binary, leaf_doc long")
    links = cut(verified(cut(likely), docs, width, percent))
    roots = components(links)
    rest = _rest(members, reps, roots, bands * rows, percent)
    more = cut(verified(cut(rest), docs, width, percent))
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    named_roots = _component_ids(roots, reps)
    single = F.when(F.col("n_shingles") > 0, F.col("first")).otherwise(F.col("doc_id"))
    # named holds each row's class and first id; only classes that were linked have another component.
    joined = named.select("doc_id", "n_shingles", "class", "first").unionByName(facts.where("n_shingles = 0").select("doc_id", "n_shingles", "class", F.lit(None).cast("long").alias("first")))
    salted = joined.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(STAR_SALTS)).cast("int"))
    spread = named_roots.select("class", "component", F.explode(F.sequence(F.lit(0), F.lit(STAR_SALTS - 1))).alias("salt"))
    component = F.coalesce("component", single)
    return salted.join(spread, ["class", "salt"], "left").select("doc_id", "n_shingles", "class", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def _estimate(coordinates: int):
    least = ESTIMATE * coordinates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, coordinates) for c in ("s1", "s2"))
            keep = pa.array((a == b).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch[c].filter(keep) for c in ("hub", "hub_doc", "leaf", "leaf_doc")], names=["hub", "hub_doc", "leaf", "leaf_doc"])

    return run


def _rest(members: DataFrame, reps: DataFrame, roots: DataFrame, coordinates: int, percent: int) -> DataFrame:
    """Pairs that may link different components within a bucket: the exact way for what stars leave open."""
    labelled = members.join(roots.select(F.col("node").alias("class"), F.col("root").alias("linked")), "class", "left").withColumn("root", F.coalesce("linked", "class"))
    mixed = labelled.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("members").alias("members")).where("low <> high")
    inside = join_groups(labelled.select("band", "class", "doc", "n_shingles", "root"), cut(mixed.select("band", "members")), "band", "members", 40)
    inside = inside.join(reps.select("class", "sig").dropDuplicates(["class"]), "class")
    blocks = F.ceil(F.col("members") / F.lit(float(BLOCK))).cast("int")
    placed = inside.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # A row meets every block once: (i, j) with i <= j, as left if it is in i, as right if it is in j.
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    keyed = pairs.select(
        F.xxhash64("band", low, high).alias("slot"),
        F.concat_ws(":", "band", low, high).alias("key"),
        (F.col("block") == low).alias("at_left"),
        (F.col("block") == high).alias("at_right"),
        "class", "doc", "n_shingles", "root", "sig",
    )
    return keyed.repartition("slot").sortWithinPartitions("key").mapInArrow(lean("near", _block_pairs(coordinates, percent), forget), "hub binary, hub_doc long, leaf binary, leaf_doc long").distinct()


def _component_ids(roots: DataFrame, reps: DataFrame) -> DataFrame:
    """(class, component): the smallest doc_id of the classes under each root."""
    linked = roots.join(reps.select(F.col("class").alias("node"), "first").dropDuplicates(["node"]), "node")
    least = with_group_values(linked, ["root"], F.xxhash64("node"), [F.min("first").alias("component")], [F.min("component").alias("component")])
    return least.select(F.col("node").alias("class"), "component")
