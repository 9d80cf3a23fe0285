"""Near-duplicate groups by SuperMinHash, banding, exact verification and union-find.

1. Each text becomes the set of its distinct word shingles (64-bit hashes) and a SuperMinHash signature: every
   element walks through its own random permutation of the ``SLOTS`` slots, offering slot number j of the walk a
   value in [j, j+1), and the walk stops as soon as no slot can still improve. One walk serves all slots, so the
   slots of a signature are negatively correlated and estimate similarity with less variance than plain MinHash.
2. Equal sets form a class, represented by its smallest doc_id: copies never become pairs.
3. ``BANDS`` bands of ``ROWS`` slots put representatives into buckets. A pair at similarity 0.8 shares no bucket
   with probability (1 - 0.8^4)^20 = 2.6e-5.
4. In each bucket every member is compared with its hub, the member that shares buckets with most others, on full
   sets; links give components. A bucket of n copies costs n comparisons.
5. Buckets whose members still lie in several components are searched across these: members outside the bucket's
   largest component against all members of other components. Inside the join a pair must have 1,024-bit codes
   (one bit of each slot of a longer signature) no further apart than sets at the threshold have in all but one
   case of 30,000; what remains is verified on full sets. Pairs inside a component can't change the result.

Sets of all texts are never stored: those of representatives in shared buckets are made again from the texts, which a bit map of
``BITS`` bits (a fixed 2 MB broadcast) selects; further ones that it lets through fall out of the join.

Edge cases: null and empty texts have an empty set and stand alone; a text with fewer words than a shingle is one
shingle; repeated rows share class and component. Rows without doc_id take part in classes, but only an id can
name a component: a group without any id has a null one and is kept. Texts that share a doc_id are told apart by
their sets. Every tie goes to the smallest doc_id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

BANDS, ROWS = 20, 4
SLOTS = BANDS * ROWS
BITS = 1 << 24
WALKS = 8_000_000
CODE_BITS = 1024

_HASHES = common.Bounded(common.word_hash)
_SEEDS = common.mix64(np.arange(1, CODE_BITS + 1, dtype=np.uint64))
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes, size: int) -> np.ndarray:
    """Distinct shingle hashes of a text, ASCII lower-cased, sorted."""
    cut = text.lower().split()
    return common.shingle_hashes(np.fromiter(map(_HASHES.__getitem__, cut), np.uint64, len(cut)), size)


def super_min_hash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """(number of sets, slots) signatures; the row of an empty set stays infinite.

    Elements walk together, about ``WALKS / slots`` at a time, so a set of any size needs the same memory.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    best = np.full((len(sets), slots), np.inf)
    step = max(1, WALKS // slots)
    for at in range(0, len(every), step):
        x, owner = every[at : at + step], owners[at : at + step]
        low = owner[0]
        own = best[low : owner[-1] + 1]
        owner = owner - low
        # the permutation of each element, as far as its walk has shuffled it
        walk = np.tile(np.arange(slots, dtype=np.uint16), (len(x), 1))
        for j in range(slots):
            # this step offers j or more
            go = (own.max(axis=1) >= j)[owner]
            if not go.all():
                x, owner, walk = x[go], owner[go], walk[go]
            if not len(x):
                break
            u = common.mix64(x ^ _SEEDS[j])
            value = (u >> np.uint64(11)).astype(np.float64) * 2.0**-53 + j
            pick = j + (common.mix64(u ^ _SECOND) % np.uint64(slots - j)).astype(np.int64)
            rows = np.arange(len(x))
            slot = walk[rows, pick]
            walk[rows, pick] = walk[:, j]
            np.minimum.at(own.reshape(-1), owner * slots + slot, value)
    return best


def codes(sets: list[np.ndarray]) -> np.ndarray:
    """(number of sets, CODE_BITS / 64): one bit of each slot of a longer signature.

    Two sets of similarity s differ in (1 - s) / 2 of the bits on average.
    """
    signatures = super_min_hash(sets, CODE_BITS)
    bits = (common.mix64(signatures.view(np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(number of sets, BANDS) bucket keys."""
    values = np.ascontiguousarray(signatures).view(np.uint64).reshape(-1, BANDS, ROWS)
    acc = np.broadcast_to(common.mix64(np.arange(BANDS, dtype=np.uint64)), values.shape[:2]).copy()
    for k in range(ROWS):
        acc = common.mix64(acc ^ values[:, :, k])
    return acc.view(np.int64)


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest, bands`` of every row; digest and bands are null for the empty set."""
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.only(_HASHES)
        for whole in batches:
            for batch in common.slices(whole, 1_000_000):
                sets = [shingles(t, size) for t in common.byte_texts(batch.column(1))]
                keys = band_keys(super_min_hash(sets))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                bands = [k if len(s) else None for s, k in zip(sets, keys, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "digest", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _bit(node) -> F.Column:
    return F.pmod(F.xxhash64(node), F.lit(BITS))


def _selected(nodes: DataFrame) -> np.ndarray:
    """A bit map of the nodes' hashes: at most BITS / 64 numbers reach the driver, whatever the input."""
    bit = _bit(F.col("node"))
    rows = (
        nodes.select((bit / 64).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(node), {BITS}), 64) as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    words = np.zeros(BITS // 64, np.int64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return words


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, set, code) of the documents whose id the bit map of ``nodes`` holds: all nodes, and chance others."""
    shared = docs.sparkSession.sparkContext.broadcast(_selected(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        common.only(_HASHES)
        for whole in batches:
            bits = whole.column(2).to_numpy()
            whole = whole.filter(pa.array((words[bits >> 6] >> (bits & 63)) & 1 == 1))
            for batch in common.slices(whole, 1_000_000):
                sets = [shingles(t, size) for t in common.byte_texts(batch.column(1))]
                made = [pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(list(codes(sets)), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["node", "set", "code"])

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("node"), "text").withColumn("bit", _bit(F.col("node")))
    return rows.mapInArrow(run, "node long, set array<long>, code array<long>")


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union, written."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    near = both * 100 >= (F.size("left") + F.size("right") - both) * percent
    return common.written(pairs.join(left, "a").join(right, "b").where(near).select("a", "b").distinct(), "links")


def _most_different(percent: int) -> int:
    """Bits in which the codes of two sets at the threshold differ, plus four standard deviations (1 in 30,000)."""
    p = (1 - percent / 100) / 2
    return round(CODE_BITS * p + 4 * (CODE_BITS * p * (1 - p)) ** 0.5)


def groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``."""
    rows = common.written(sketch(docs, size), "sketches")
    classes = rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.min_by("bands", F.struct("doc_id")).alias("bands"))
    classes = common.written(classes, "classes")

    spread = classes.where("node is not null").select("node", F.explode("bands").alias("bucket")).distinct()
    shared = spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    spread = common.written(spread.join(shared, "bucket"), "buckets")
    # the hub of a bucket is its most central member, one that meets most others: the likely origin of copies
    central = spread.groupBy("node").agg(F.sum("members").alias("meets"))
    hubs = spread.join(central, "node").groupBy("bucket").agg(F.max_by("node", F.struct(F.col("meets"), -F.col("node"))).alias("hub"))
    members = common.written(spread.join(hubs, "bucket").select("bucket", "node", "hub"), "members")
    nodes = members.select("node").distinct()
    sets = common.written(_sets(docs, nodes, size).join(nodes, "node", "left_semi"), "sets")
    links = _verified(sets, members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), percent)

    found = common.components(links)
    placed = members.join(found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts")).where("parts > 1")
    placed = common.written(placed.join(mixed.select("bucket", "largest"), "bucket"), "mixed")
    known = placed.groupBy("node").agg(F.array_sort(F.collect_set("bucket")).alias("buckets")).join(sets.select("node", "code"), "node")
    placed = common.written(placed.join(known, "node"), "coded")
    a = placed.where("component <> largest").alias("a")
    b = placed.alias("b")
    differ = sum((F.bit_count(F.col("a.code")[k].bitwiseXOR(F.col("b.code")[k])) for k in range(CODE_BITS // 64)), F.lit(0))
    # tested inside the join: other components, codes near enough, and the first bucket that both share
    across = (
        a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.component") != F.col("b.component"))
               & ((F.col("b.component") == F.col("b.largest")) | (F.col("a.node") < F.col("b.node")))
               & (differ <= _most_different(percent)) & (F.array_min(F.array_intersect("a.buckets", "b.buckets")) == F.col("a.bucket")))
        .select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
    )
    more = _verified(sets, common.written(across, "across"), percent)
    found = common.components(links.union(more))

    named = (
        classes.join(found, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("component_id"))
    )
    # texts without words have no digest and are linked with nothing: they don't meet in the join
    rows = rows.drop("bands")
    result = rows.where("digest is not null").join(named, "digest", "left").unionByName(
        rows.where("digest is null").withColumn("component_id", F.lit(None).cast("long"))
    )
    component = F.coalesce("component_id", "doc_id")
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, that of its smallest doc_id, with all columns of ``docs``."""
    name = common.fresh(docs.columns, "kept_id")
    kept = groups(docs, size, percent).where("kept").select(F.col("doc_id").alias(name)).distinct()
    # equal rows lie together after the join by doc_id, so dropping repeats needs no other exchange
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_semi").dropDuplicates(["doc_id", "text"])
