"""Filter interaction audit: what each filter of a sequence removes, for every order of the filters.

A document's *mask* holds the filters it fails. With the orders in lexicographic rank, the orders in which a mask is
removed at step s by filter f are those that begin with s - 1 filters outside the mask, then f: an interval of
(F - s)! consecutive ranks for each such prefix, which begins at the prefix's Lehmer rank. So :func:`audit` adds a mask's counts at
the ends of its intervals in one difference array for each step, and a prefix sum over the 120 ranks gives the documents removed at each step of
each order. Everything else follows from these totals.

Plan: one narrow pass gives (id, part, text digest, mask of the text filters). The duplicate filter needs each digest's smallest id:
rows are counted by (digest, id), the smallest id by digest, and only the rows of the smallest ids are looked up again, by (digest, id). So a
text that a third of the rows share is summed in partial counts and never meets in one task. The masks of a part are at most
32 rows.

Edge cases: a null or empty text has no words; it fails A, and E where a smaller id's text is empty too. A row fails E if a
*smaller id* has the text, so repeated rows of one id don't fail by each other, and a null id neither fails E nor counts as smaller. A null source is the part ''.
Several label rows of an id: a 1 in any of them counts. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

LETTERS = "ABCDE"
FEWEST_WORDS, SYMBOLS = 200, b"#$%&*|"
BLOCK = 4_000_000

_UPPER, _NOT_UPPER = bytes(range(65, 91)), bytes(b for b in range(256) if not 65 <= b <= 90)
_CONTINUES = bytes(range(128, 192))
_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)


def text_mask(text: bytes) -> int:
    """The bits of A to D of a text's bytes; long texts are split in blocks that end at a blank."""
    n, distinct, at = 0, set(), 0
    while at < len(text):
        stop = len(text) if len(text) - at <= BLOCK else at + BLOCK
        while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
            stop += 1
        words = text[at:stop].split()
        n += len(words)
        distinct.update(words)
        at = stop
    points = len(text) if text.isascii() else len(text.translate(None, _CONTINUES))
    upper = len(text.translate(None, _NOT_UPPER))
    return (n < FEWEST_WORDS) | (100 * len(distinct) < 50 * n) << 1 | (100 * upper > 2 * points) << 2 | bool(text.translate(None, _NOT_SYMBOL)) << 3


def measure(docs: DataFrame, part: str) -> DataFrame:
    """``doc_id, part, digest, mask`` of every text; the mask without E."""
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for text in common.byte_texts(batch.column(1)):
                masks.append(text_mask(text))
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())], ["doc_id", "part", "digest", "mask"]
            )

    columns = F.col("doc_id").cast("long"), "text", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    return docs.select(*columns).mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def mask_counts(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those of label quality 1 and toxic 1, of each set of failed filters."""
    one = F.max(F.coalesce(F.col("quality") == 1, F.lit(False))), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)))
    labelled = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one[0].alias("good"), one[1].alias("toxic"))
    labelled = labelled.where("good or toxic")
    key = ["digest", "doc_id", "part", "mask"]
    rows = measured.groupBy(*key).agg(F.count("*").alias("n"))
    # null ids find no label; they are dealt out by their digests
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("spread", spread).join(labelled.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
    no = F.lit(False)
    rows = common.written(rows.select(*key, "n", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")), "audit-rows")
    named = rows.where("doc_id is not null")
    # the rows that hold the smallest id of their text pass E; a null id passes it by definition
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    passing = named.join(first, ["digest", "doc_id"]).withColumn("bit", F.lit(0))
    # all rows with an id count as failing E, and those that pass it are moved from there
    moved = passing.withColumns({"bit": F.lit(16), "n": -F.col("n")})
    every = named.withColumn("bit", F.lit(16)).unionByName(moved).unionByName(passing).unionByName(rows.where("doc_id is null").withColumn("bit", F.lit(0)))
    total = [F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")]
    return every.groupBy("part", F.col("mask").bitwiseOR(F.col("bit")).alias("mask")).agg(*total).where("n > 0")


def intervals(filters: int) -> np.ndarray:
    """(mask, step, first rank, rank after the last) of every prefix of passed filters that ends in a failed one."""
    out = []
    for size in range(1, filters + 1):
        for prefix in itertools.permutations(range(filters), size):
            lehmer = [f - sum(g < f for g in prefix[:i]) for i, f in enumerate(prefix)]
            first = sum(c * math.factorial(filters - 1 - i) for i, c in enumerate(lehmer))
            open_bits = [f for f in range(filters) if f not in prefix]
            # the last filter fails, those before it pass, the rest may do either
            for rest in itertools.product((0, 1), repeat=len(open_bits)):
                mask = 1 << prefix[-1] | sum(bit << f for bit, f in zip(rest, open_bits, strict=True))
                out.append((mask, size - 1, first, first + math.factorial(filters - size)))
    return np.array(out, np.int64)


def totals(counts: np.ndarray, spans: np.ndarray, filters: int) -> np.ndarray:
    """removed[step, rank, column] from ``counts[mask, column]``, by difference arrays over the ranks."""
    edges = np.zeros((filters, math.factorial(filters) + 1, counts.shape[1]), np.int64)
    mask, step, first, after = spans.T
    np.add.at(edges, (step, first), counts[mask])
    np.subtract.at(edges, (step, after), counts[mask])
    return np.cumsum(edges, axis=1)[:, :-1]


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``: the rows of all orders of each part."""
    common.ship(masks.sparkSession)
    filters, spans = len(letters), intervals(len(letters))
    orders = np.array(list(itertools.permutations(range(filters))), np.int64)
    names = ["".join(letters[f] for f in order) for order in orders]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = np.arange(len(orders))
        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.zeros((1 << filters, 3), np.int64)
                for c in cells:
                    counts[c["mask"]] = c["n"], c["good"], c["toxic"]
                removed = totals(counts, spans, filters)
                kept = counts[:, 0].sum() - np.cumsum(removed[:, :, 0], axis=0)
                bits = np.arange(1 << filters)
                fails = np.array([counts[bits >> f & 1 == 1, 0].sum() for f in range(filters)])
                unique = counts[1 << np.arange(filters), 0]
                shapley = np.zeros(filters, np.int64)
                for step in range(filters):
                    np.add.at(shapley, orders[:, step], removed[step, :, 0])
                for step in range(filters):
                    f, here = orders[:, step], removed[step]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part] * len(ranks), pa.string()), pa.array(names), pa.array(np.full(len(ranks), step + 1, np.int32)), pa.array(kept[step]),
                            pa.array(here[:, 0]), pa.array(fails[f] - here[:, 0]), pa.array(unique[f]), pa.array(here[:, 1]), pa.array(here[:, 2]), pa.array(shapley[f]),
                        ],
                        ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
                    )

    cells = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return cells.mapInArrow(run, schema)


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of the five text filters over whole documents."""
    return audit(mask_counts(measure(docs, part), labels))
