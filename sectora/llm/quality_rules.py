"""Quality rules: word statistics of each text, and lines that too many documents of a host share.

Lines are normalised (ASCII lower case, digits as 0, no ASCII punctuation, single spaces) and hashed. For each
(host, line) the distinct documents that hold it are counted; documents with equal texts count as one, so that
plain copies, which are the deduplicator's business, don't make boilerplate of their own lines. A line in more than
``SHARE`` of its host's documents is removed, and a document is rejected when fewer than ``LEAST_LEFT`` of its words, or
fewer than ``LEAST_WORDS`` words, remain. The share is the limit at every size of a host; ``MIN_DOCUMENTS`` only asks that
a line is seen in more than that few documents, as a share of a handful of documents says nothing.

Shuffles carry (host, hash, digest) of each distinct line of a document and are summed before they are sent: a host
or line that holds a third of all rows is spread by the digest first, and its partial counts meet afterwards.

Edge cases: a null or empty text has no words, so it fails the base rules. A null host is a host of its own. Lines
without letters, digits or other non-punctuation are never removed. Repeated rows give equal rows and, having equal
texts, count once. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

MIN_DOCUMENTS, SHARE = 3, 0.05
LEAST_LEFT, LEAST_WORDS = 0.3, 5
WINDOW = 5

_FOLD = bytes(ord("0") if chr(b) in "0123456789" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_DROP = string.punctuation.encode()
_NOT_SYMBOL = bytes(b for b in range(256) if chr(b) not in "#*$%&|<>")
_SPACE = b" \t\n\r\x0b\x0c"

_HASHES = common.Bounded(common.word_hash)


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.translate(_FOLD, _DROP).split())


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    acc = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        acc = common.mix64(acc ^ h[k : k + n])
    order = np.argsort(acc)
    same = acc[order[1:]] == acc[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(n + WINDOW, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: bytes) -> tuple[int, int, int, int, int, list[tuple[int, int]]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and (hash, words) of each distinct line."""
    words = text.split()
    # code points: bytes that don't continue one
    chars = sum(map(len, words)) if text.isascii() else len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text.translate(None, _NOT_SYMBOL))
    seen, twice, lines = set(), 0, {}
    for line in text.split(b"\n"):
        if not line.strip(_SPACE):
            continue
        twice += line in seen
        seen.add(line)
        if normal := normal_line(line):
            key = xxhash.xxh3_64_intdigest(normal)
            lines[key] = lines.get(key, 0) + len(line.split())
    return len(words), chars, symbols, twice, repeated_words(words), list(lines.items())


def measure(docs: DataFrame, host: str) -> DataFrame:
    """One row per text: the statistics, a digest of the text and its distinct lines."""
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.only(_HASHES)
        for whole in batches:
            for batch in common.slices(whole):
                rows, digests, hashes, counts = [], [], [], []
                for text in common.byte_texts(batch.column(1)):
                    *numbers, lines = statistics(text)
                    rows.append(numbers)
                    digests.append(hashlib.md5(text).digest()[:8])
                    hashes.append(np.array([k for k, _ in lines], np.uint64).view(np.int64))
                    counts.append(np.array([n for _, n in lines], np.int32))
                cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                digest = pa.array(np.frombuffer(b"".join(digests), np.int64))
                more = [digest, pa.array(hashes, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int32()))]
                names = ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "digest", "line", "words"]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *cols, *more], names)

    schema = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, digest long, line array<long>, words array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text", F.col(host).cast("string").alias("host")).mapInArrow(run, schema)


def judge(docs: DataFrame, host: str = "source", min_documents: int = MIN_DOCUMENTS, share: float = SHARE) -> DataFrame:
    """Per text: the statistics, ``base_failed``, ``n_removed_words``, ``kept``."""
    stats = common.written(measure(docs, host).withColumn("row", F.monotonically_increasing_id()), "line-statistics")
    key = F.coalesce("host", F.lit("")), F.col("host").isNull()
    texts = stats.select(*[k.alias(n) for k, n in zip(key, ("h", "none"), strict=True)], "digest").distinct()
    hosts = texts.groupBy("h", "none").agg(F.count("*").alias("documents"))
    lines = stats.select(*[k.alias(n) for k, n in zip(key, ("h", "none"), strict=True)], "row", "digest", F.explode(F.arrays_zip("line", "words")).alias("l"))
    lines = lines.select("h", "none", "row", "digest", F.col("l.line").alias("line"), F.col("l.words").alias("words"))
    # copies of a text meet first, spread by its digest; then one count per (host, line), summed map-side
    found = lines.select("h", "none", "line", "digest").distinct().groupBy("h", "none", "line").agg(F.count("*").alias("found"))
    # a line at or under the smallest possible limit needs no look at its host
    common_lines = (
        found.where(F.col("found") > min_documents).join(hosts, ["h", "none"])
        .where(F.col("found") > F.greatest(F.lit(float(min_documents)), F.lit(share) * F.col("documents"))).select("h", "none", "line")
    )
    removed = lines.join(common_lines, ["h", "none", "line"]).groupBy("row").agg(F.sum("words").alias("n_removed_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))
    depleted = (F.col("n_removed_words") > 0) & ((left < LEAST_LEFT * F.col("n_words")) | (left < LEAST_WORDS))
    return (
        stats.drop("line", "words", "digest").join(removed, "row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~failed & ~depleted).alias("kept"), "n_removed_words")
    )
