"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes a TF-IDF vector over hashed word shapes (``Thonst`` -> ``Aa``, ``in%%%`` -> ``a%%%``), hashed words and
a few document traits (repetition of words and lines). The ``RANK`` leading singular vectors of the labelled sample
project it to a unit vector. Cosines to every labelled vector are exact, in blocks of documents against the
broadcast sample; the ``NEIGHBOURS`` nearest vote, each with its label weighted by its similarity.

The fit uses a bounded sample: the ``SAMPLE`` training labels of smallest hash of their id. Only that sample
(a few MB) passes through the driver. Scores use the text alone.

Edge cases: a null or empty text, or one of white space only, has no vector and scores 0.0 (rejected). With no usable label every other text
scores 0.5. Ties among neighbours go to the first in the order of the sample (hash of the id), so scores do not
depend on partitions. Several labels of one document: the smallest counts. Repeated rows give equal
rows, scores up to single precision.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

SAMPLE, RANK, NEIGHBOURS, SHARPNESS, ACCEPT = 6000, 64, 25, 4, 0.7
#: Buckets of shapes, words and traits; a packed word keeps 10 bits for each of the first two.
SHAPES, WORDS, TRAITS = 512, 1024, 64
SIZE = SHAPES + WORDS + TRAITS
BLOCK = 256



#: Letters become a or A (bytes of other alphabets a), digits 0; other characters stay.
_KIND = bytes(ord("0") if chr(b).isdigit() and b < 128 else ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else b for b in range(256))
_RUN = re.compile(rb"([aA0])\1+")


def _shape(kinds: bytes) -> int:
    """The bucket of a word's whole shape: runs of one kind count once."""
    return zlib.crc32(_RUN.sub(rb"\1", kinds)) % SHAPES


_SHAPES = common.Bounded(_shape, 100_000)


def _packed(word: bytes) -> int:
    """crc32 of the word, then its word bucket, then its shape bucket."""
    return zlib.crc32(word) << 20 | (zlib.crc32(word.lower()) % WORDS) << 10 | _SHAPES[word.translate(_KIND)]


_WORDS = common.Bounded(_packed)


def _trait(values: list[tuple[int, float]]) -> list[int]:
    """One of 8 bins for each trait value in 0..1."""
    return [SHAPES + WORDS + k * 8 + min(7, int(v * 8)) for k, v in values]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
    """(feature ids, weights) before idf; None for a text without words."""
    cut = common.words(text)
    if not cut:
        return None
    packed = np.fromiter(map(_WORDS.__getitem__, cut), np.int64, len(cut))
    shapes = np.bincount(packed & 1023, minlength=SHAPES)
    low = np.bincount((packed >> 10) & 1023, minlength=WORDS)
    ids = np.concatenate([np.flatnonzero(shapes), SHAPES + np.flatnonzero(low)])
    n = len(cut)
    # shapes by their share of the text, so a part of junk shows at any length
    weights = np.concatenate([np.sqrt(shapes[shapes > 0] / n) * 4, np.sqrt(low[low > 0] / n)])
    crc = packed >> 20
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = float(np.mean(crc[1:] == crc[:-1])) if n > 1 else 0.0
    pairs = crc[1:] * 31 + crc[:-1]
    again = 1 - len(np.unique(pairs)) / len(pairs) if n > 1 else 0.0
    traits = _trait([(0, min(1.0, same * 3)), (1, again), (2, 1 - len(set(lines)) / len(lines)), (3, min(1.0, np.log2(n) / 12))])
    return np.concatenate([ids, np.array(traits)]), np.concatenate([weights, [1.0, 1.0, 1.0, 0.2]])


def _vectors(column: pa.Array) -> np.ndarray:
    out = np.zeros((len(column), SIZE), np.float32)
    for row, text in enumerate(common.byte_texts(column)):
        if (f := features(text)) is not None:
            out[row, f[0]] = f[1]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model:
    """idf, projection and the labelled vectors; a few MB whatever the input."""

    def __init__(self, raw: np.ndarray, labels: np.ndarray):
        keep = raw.any(axis=1)
        raw, self.labels = raw[keep], labels[keep].astype(np.float32)
        n = max(1, len(raw))
        self.idf = (1 + np.log((1 + n) / (1 + (raw > 0).sum(axis=0)))).astype(np.float32)
        weighted = raw * self.idf
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
        # in blocks: the driver holds double precision for one block only
        gram = np.zeros((SIZE, SIZE))
        for at in range(0, len(weighted), BLOCK):
            block = weighted[at : at + BLOCK].astype(np.float64)
            gram += block.T @ block
        _, axes = np.linalg.eigh(gram)
        axes = axes[:, ::-1][:, : min(RANK, SIZE)]
        axes *= np.where(np.take_along_axis(axes, np.abs(axes).argmax(axis=0)[None], 0) < 0, -1, 1)
        self.axes = axes.astype(np.float32)
        self.points = _unit(weighted @ self.axes) if len(raw) else np.zeros((0, self.axes.shape[1]), np.float32)

    def scores(self, raw: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest neighbours of each row."""
        if not len(self.points):
            return np.where(raw.any(axis=1), 0.5, 0.0)
        here = _unit(_unit(raw * self.idf) @ self.axes)
        near = here @ self.points.T
        k = min(NEIGHBOURS, near.shape[1])
        cut = np.partition(near, -k, axis=1)[:, -k][:, None]
        # all strictly nearer ones, then the first of those at the cut
        sure, edge = near > cut, near == cut
        take = sure | (edge & (np.cumsum(edge, axis=1) <= k - sure.sum(axis=1, keepdims=True)))
        rows, cols = np.nonzero(take)
        weight = np.maximum(near[rows, cols], 0.0).astype(np.float64) ** SHARPNESS + 1e-9
        total = np.bincount(rows, weight, len(raw))
        return np.where(raw.any(axis=1), np.clip(np.bincount(rows, weight * self.labels[cols], len(raw)) / total, 0, 1), 0.0)


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE) -> Model:
    """Fit on the ``sample`` labelled rows of smallest id hash among those where ``training`` holds."""
    common.ship(docs.sparkSession)
    chosen = (
        labels.where(training & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    # at most `sample` rows of two numbers: the bound of this broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [v.tobytes() for v in _vectors(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(vectors, pa.binary())], ["doc_id", "label", "vector"])

    got = rows.selectExpr("cast(doc_id as long) doc_id", "text", "cast(label as int) label").mapInArrow(run, "doc_id long, label int, vector binary").toPandas()
    # the order decides ties: the same whatever the partitions
    got = got.assign(key=common.mix64(got.doc_id.to_numpy(np.int64).view(np.uint64))).sort_values(["key", "doc_id"])
    raw = np.frombuffer(b"".join(got.vector), np.float32).reshape(-1, SIZE) if len(got) else np.zeros((0, SIZE), np.float32)
    return Model(raw, got.label.to_numpy(np.int64))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score as column ``name`` (replacing an input column of that name)."""
    spark = docs.sparkSession
    common.ship(spark)
    shared = spark.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c != "text" and c.lower() != name.lower()]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.only(_WORDS)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                scores = shared.value.scores(_vectors(batch.column(0)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], ["text", *rest, name])

    schema = "text string" + "".join(f", `{c}` {kinds[c]}" for c in rest) + f", `{name}` double"
    made = docs.select("text", *[f"`{c}`" for c in rest]).mapInArrow(run, schema)
    return made.select(*[f"`{c}`" for c in docs.columns if c == "text" or c in rest], f"`{name}`")


def held_out() -> Column:
    return common.crc_mod("doc_id", 4) == 2


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every text; learns only from labels that are not held out."""
    model = fit(docs, labels, ~held_out())
    return score(docs.selectExpr("cast(doc_id as long) doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns."""
    name = common.fresh(docs.columns, "score")
    return score(docs, fit(docs, labels, ~held_out()), name).where(F.col(name) >= ACCEPT).drop(name)
