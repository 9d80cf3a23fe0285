"""Helpers shared by the training-data operators: text tokens, written intermediates, graph components.

Conventions that hold for every operator here:

* A null text counts as the empty text unless the operator says otherwise.
* Intermediates that feed more than one job are written as Parquet under ``spark.checkpoint.dir`` and read
  again (:func:`written`), so a lost executor costs its own tasks only and nothing is computed twice.
* Functions that run in Python workers get Arrow batches and handle one text at a time.
"""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectora.session import scratch_path

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    target = os.path.join(tempfile.mkdtemp(prefix="sectora-zip-"), "sectora_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends here, for all readers."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores until no column has it in any letter case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(column: str, mod: int):
    """crc32 of the id's decimal text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow string column, one at a time; null gives b''."""
    raw = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    for value in raw:
        yield value.as_py() or b""


def slices(batch: pa.RecordBatch, most_bytes: int = 4_000_000, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch (the text in ``column``) of about ``most_bytes`` of text, one row at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most_bytes if len(sizes) else sizes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def words(text: bytes) -> list[bytes]:
    """Maximal runs of bytes outside space and \\x09-\\x0D (bytes.split knows exactly these)."""
    return text.split()


_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 steps) over a uint64 array."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


_MEMOS: weakref.WeakValueDictionary = weakref.WeakValueDictionary()


def memo(holder):
    """Register what holds a memo and can ``clear()`` it."""
    _MEMOS[id(holder)] = holder
    return holder


def only(holder) -> None:
    """Workers outlive their tasks: a task that uses ``holder`` first empties the memos that other operators left."""
    for other in list(_MEMOS.values()):
        if other is not holder:
            other.clear()


class Bounded(dict):
    """A memo of ``make(key)`` that empties itself at ``limit`` entries, so that a worker's memory stays bounded."""

    def __init__(self, make, limit: int = 200_000):
        super().__init__()
        self.make, self.limit = make, limit
        memo(self)

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def word_hash(word: bytes) -> int:
    """A 64-bit hash that is the same in every process."""


    return xxhash.xxh3_64_intdigest(word)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of all ``size``-word shingles; a shorter sequence is one shingle, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    take = min(size, n)
    with np.errstate(over="ignore"):
        acc = np.zeros(n - take + 1, np.uint64)
        for k in range(take):
            acc = mix64(acc ^ hashes[k : n - take + 1 + k])
    if n < size:
        acc = mix64(acc + np.uint64(n))
    return np.unique(acc)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's links: each node it saw, linked to the smallest id of its local tree."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = p
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = [x for x in up if top(x) != x]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([top(x) for x in part], pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable over undirected links ``(a, b)``.

    Each partition first shrinks its links to a forest by union-find. Then rounds of hash joins hook every
    tree on the smallest neighbouring root and halve the paths, until no link crosses two trees. Each round's
    links and labels are written; the driver sees only a count. Ids are longs; self links are ignored.
    """
    ship(links.sparkSession)
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    links = written(links.mapInArrow(_forest, "a long, b long"), "forest")
    while True:
        # large star: every node's larger neighbours go to its smallest neighbour
        both = links.union(links.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: every node's smaller neighbours, and itself, go to the smallest of them
        down = large.where("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low)
        after = written(small.where("a <> b").distinct(), "stars")
        # done when every node hangs on one root that hangs on nothing
        roots = after.select("b").distinct().join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        several = after.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
        if roots.isEmpty() and several.isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        links = after
