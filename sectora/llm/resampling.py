"""Target-distribution importance resampling: documents drawn by how much their hashed n-grams look like a target.

Every run of ``low`` to ``high`` consecutive words is a feature; its bucket is the CRC-32 of its bytes modulo
``buckets``. With ``s`` and ``t`` the bucket's counts in the corpus and in the target, a feature gains
``floor(1000 ln(...))`` of their smoothed ratio, a document weighs the sum of its gains, and Gumbel noise drawn from
its id turns the highest scores into a sample without replacement.

The checksums are taken by *length-bucketed matrices* (:func:`crc32_all`): the distinct features of a block are grouped by
length into two-dimensional uint8 arrays, all registers of an array advance column by column, and the results are
scattered back. A feature longer than ``WIDE`` bytes becomes a matrix of its own, whose row registers are folded.

Plan: one narrow pass counts buckets (each task sends at most ``buckets`` rows), the counts come to the driver
(``buckets`` rows, whatever the corpus), a second narrow pass weighs. The ranks come from one range exchange of
(id, score): a row's rank is its place in its range plus the rows of the ranges before it.

Edge cases: a null or empty text, or one without words, has no features and weight 0. A null id is hashed as the empty
text and comes last among ties. Repeated rows give rows equal but for their ranks. Long texts are read in blocks. An
empty table gives no rows; an empty target gives T = 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

BUCKETS, SEED, LEAST, PERCENT = 10_000, "2024", 20, 10
WIDE, BLOCK = 1024, 4_000_000

#: ASCII letters in lower case, digits and all bytes of other characters stay; the rest separates words.
_FOLD = bytes(b if chr(b).isdigit() or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: A row's place: the task in the upper bits, the row of the task in the lower 33 (how Spark numbers rows).
_ROW_BITS = 33


def _byte_table() -> np.ndarray:
    """The register after one byte, for each byte: eight steps of the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_TABLE = _byte_table()


def _advance(registers: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """All registers after their rows of ``matrix``, one column at a time."""
    for column in np.ascontiguousarray(matrix.T):
        registers = _TABLE[(registers ^ column) & 0xFF] ^ (registers >> 8)
    return registers


#: What WIDE zero bytes make of each single bit of a register; the map is linear, so this is all of it.
_SHIFTED = _advance(np.uint32(1) << np.arange(32, dtype=np.uint32), np.zeros((32, WIDE), np.uint8))
_BITS = np.arange(32, dtype=np.uint32)


def _folded(feature: bytes) -> np.uint32:
    """The register of one long feature: its rows of WIDE bytes run side by side and are folded from the left."""
    data, head = np.frombuffer(feature, np.uint8), len(feature) % WIDE
    register = _advance(np.array([0xFFFFFFFF], np.uint32), data[None, :head])[0]
    rows = data[head:].reshape(-1, WIDE)
    for row in _advance(np.zeros(len(rows), np.uint32), rows):
        register = np.bitwise_xor.reduce(_SHIFTED[(register >> _BITS) & 1 == 1], initial=np.uint32(0)) ^ row
    return register


def crc32_all(features: list[bytes]) -> np.ndarray:
    """The CRC-32 of each feature."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    data = np.frombuffer(b"".join(features[i] for i in order), np.uint8)
    out = np.full(len(features), 0xFFFFFFFF, np.uint32)
    at = 0
    sizes, first = np.unique(lengths[order], return_index=True)
    for size, a, b in zip(sizes.tolist(), first, np.append(first, len(order))[1:], strict=True):
        if size <= WIDE:
            matrix = data[at : at + size * (b - a)].reshape(b - a, size)
            out[order[a:b]] = _advance(out[order[a:b]], matrix)
        else:
            out[order[a:b]] = [_folded(features[i]) for i in order[a:b]]
        at += size * (b - a)
    return out ^ np.uint32(0xFFFFFFFF)


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``BLOCK`` bytes; no word is cut."""
    plain, at = text.translate(_FOLD), 0
    while at < len(plain):
        stop = len(plain) if len(plain) - at <= BLOCK else plain.find(b" ", at + BLOCK)
        stop = len(plain) if stop < 0 else stop
        yield plain[at:stop].split()
        at = stop


def features_of(text: bytes, low: int, high: int) -> Iterator[tuple[int, list[bytes]]]:
    """(words, features) of each block; runs that cross blocks belong to the block they end in."""
    before: list[bytes] = []
    for words in word_blocks(text):
        if low == high == 1:
            yield len(words), words
            continue
        run, out = before + words, []
        for n in range(low, high + 1):
            out += [b" ".join(run[i - n : i]) for i in range(max(n, len(before) + 1), len(run) + 1)]
        before = run[len(run) - min(len(run), high - 1) :]
        yield len(words), out


def _blocks(batches: Iterator[pa.RecordBatch], column: int, low: int, high: int):
    """Per batch: the batch and, for blocks of several texts, (row, words, features) of each part."""
    for batch in batches:
        def parts(batch=batch):
            held, size = [], 0
            for row, text in enumerate(common.byte_texts(batch.column(column))):
                for n, features in features_of(text, low, high):
                    held.append((row, n, features))
                    size += len(features)
                    if size >= BLOCK // 8:
                        yield held
                        held, size = [], 0
            if held:
                yield held
        yield batch, parts()


def _hashed(parts: list[tuple[int, int, list[bytes]]], buckets: int) -> np.ndarray:
    """The bucket of every feature of a block: each distinct one is hashed once."""
    distinct = list({f for _, _, features in parts for f in features})
    place = dict(zip(distinct, range(len(distinct)), strict=True))
    all_of = np.fromiter((place[f] for _, _, features in parts for f in features), np.int64)
    return (crc32_all(distinct) % np.uint32(buckets)).astype(np.int64)[all_of]


def bucket_counts(texts: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    """(bucket, n) over the features of all texts."""
    common.ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, blocks in _blocks(batches, 0, low, high):
            for parts in blocks:
                total += np.bincount(_hashed(parts, buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, low: int, high: int, buckets: int) -> np.ndarray:
    """The gain of each bucket, from at most ``buckets`` counts of either table."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, texts in ((s, corpus), (t, target)):
        for r in bucket_counts(texts, low, high, buckets).collect():
            counts[r.bucket] = r.n
    of_all, of_target = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((b + 1.0) * of_all / ((a + 1.0) * of_target))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, low: int, high: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every text, in one narrow pass."""
    common.ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch, blocks in _blocks(batches, 1, low, high):
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for parts in blocks:
                rows = np.array([row for row, _, _ in parts])
                sizes = np.array([len(f) for _, _, f in parts])
                ends = np.cumsum(sizes)
                sums = np.concatenate(([0], np.cumsum(gain[_hashed(parts, len(gain))])))
                np.add.at(words, rows, [n for _, n, _ in parts])
                np.add.at(features, rows, sizes)
                np.add.at(weight, rows, sums[ends] - sums[ends - sizes])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(features), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str):
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the seed and the id."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = BUCKETS, seed: str = SEED, least: int = LEAST, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn.

    Drawn are ``percent`` of the documents of at least ``least`` words, by score, ties to the smaller id.
    """
    weighed = weigh(docs, gains(docs, target, low, high, buckets), low, high)
    scored = common.written(
        weighed.withColumns({"score": F.col("weight") + noise(seed), "row": F.monotonically_increasing_id()}), "importance"
    )
    # equal scores and ids are told apart by the written row number, so one value never fills a range
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    eligible = scored.where(F.col("n_words") >= least)
    ranged = common.written(
        eligible.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "importance-order"
    )
    task = F.shiftright("place", _ROW_BITS)
    sizes = sorted(ranged.groupBy(task.alias("task")).count().collect())  # one row for each range
    before, n = [], 0
    for r in sizes:
        before.append((r[0], n))
        n += r[1]
    offsets = docs.sparkSession.createDataFrame(before, "task long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    ranked = ranged.join(F.broadcast(offsets), task == F.col("task")).withColumn("rank", F.when(rank <= percent * n // 100, rank))
    short = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(*out).unionByName(short.select(*out))
