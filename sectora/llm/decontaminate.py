"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit distance.

Texts and benchmark items become sequences of normalised words (lower case, letters and digits only). A document is
contaminated by an item of n words if some stretch of it is within ``EDITS * n`` word edits of the item.

* A CGK walk reads a window with a pointer: step j writes the word under the pointer and moves on or stays by a
  random bit of (j, word). Two sequences at a small edit distance soon walk in step again, so their edit distance
  becomes a Hamming distance of the written sequences.
* Bit sampling: each of some independent walks hashes a few written positions; window and item become a candidate
  pair when a hash is equal. Items are grouped by length, and windows have the length of the group. How many walks and
  positions, ``effort`` takes from the group's longest item so that ``recall`` reaches 0.95 at its full distance.
* Every candidate is verified by the exact edit distance of the item to its best stretch around the window.

Walks start only where they can succeed: by the q-gram lemma a stretch within e edits of an item of n words shares at
least n - 1 - 2e of the item's word pairs, so windows holding fewer pairs of the length group's items are skipped.
This condition is necessary, it loses no match.

``recall`` estimates by simulation which share of stretches at the full distance is found.

The benchmark is read in blocks of ``BLOCK`` items, each broadcast (bounded by the block), each with one pass over
the documents: no shuffle, no join of documents with anything.

Items under ``MIN_WORDS`` words allow no edit and are searched word for word.

Edge cases: null and empty texts hold nothing; null items and items without words are never reported; equal items are each reported; repeated rows give equal rows; ties between stretches go to the first. Empty
tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

EDITS, MIN_WORDS = 0.2, 5
#: Items below this length drop no document in ``clean``.
LEAST_WORDS = 3
GROUPS = 60
BLOCK = 20_000

_DROP = re.compile(r"[\W_]+")


def normal(word: bytes) -> str:
    text = word.decode("utf-8", "replace").lower()
    return text if text.isalnum() else _DROP.sub("", text)


def allowed(n: int) -> int:
    return int(EDITS * n)


def effort(n: int) -> tuple[int, int]:
    """(walks, positions sampled by each) for items of at most n words.

    The walks agree less the longer an item is, as the edits allowed grow with it. Simulated at the full distance, 3
    positions need up to 24 walks for a recall of 0.95 up to 60 words (but 52 at 120 words and 104 at 200), and 2
    positions need 0.10 to 0.17 walks a word for 0.97 between 120 and 500 words: 20 at 120, 28 at 200, 44 at 300, 72 at 500.
    """
    return (24, 3) if n <= 60 else (max(24, -(-n // 5)), 2)


class Benchmark:
    """A block of items, ready to be searched for; everything in it is bounded by the block."""

    def __init__(self, items: list[tuple[int, str | None]], seed: int = 0, least_words: int = 1):
        cut = [(i, [w for w in map(normal, (t or "").encode().split()) if w]) for i, t in items]
        order = lambda x: (len(x[1]), x[0] if x[0] is not None else -1)
        short = sorted((x for x in cut if max(1, least_words) <= len(x[1]) < MIN_WORDS), key=order)
        cut = sorted((x for x in cut if len(x[1]) >= max(MIN_WORDS, least_words)), key=order)
        self.ids = [i for i, _ in cut + short]
        self.vocab = {w: k + 1 for k, w in enumerate(dict.fromkeys(w for _, c in cut + short for w in c))}
        self.items = [np.array([self.vocab[w] for w in c], np.int64) for _, c in cut + short]
        #: Items that allow no edit, by length: sorted hashes of their words, and their numbers
        self.exact: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({len(c) for _, c in short}):
            members = np.array([k for k in range(len(cut), len(self.items)) if len(self.items[k]) == n])
            keys = self.run_hashes(np.concatenate([self.items[k] for k in members]), n)[::n]
            self.exact[n] = keys[np.argsort(keys, kind="stable")], members[np.argsort(keys, kind="stable")]
        self.base = len(self.vocab) + 1
        #: id of a raw word: 0 if no item has it, -1 if nothing of it is left
        self.raw = common.Bounded(lambda w: self.vocab.get(n, 0) if (n := normal(w)) else -1)
        sizes = np.array([len(c) for _, c in cut], np.int64)
        ratio = max(1.02, (sizes.max() / MIN_WORDS) ** (1 / GROUPS)) if len(sizes) else 1.1
        group = np.unique(np.floor(np.log(sizes / MIN_WORDS) / np.log(ratio) + 1e-9), return_inverse=True)[1] if len(sizes) else sizes
        self.groups = []
        pairs: dict[int, int] = {}
        draw = np.random.default_rng(seed)
        for g in range(int(group.max()) + 1 if len(group) else 0):
            members = np.flatnonzero(group == g)
            low, high = int(sizes[members].min()), int(sizes[members].max())
            # positions of the written sequence that each walk samples: while its pointer is inside the item
            at = np.sort(draw.integers(0, 2 * low, effort(high)), axis=1)
            # the least over all lengths: it falls by one where another edit is allowed
            need = max(1, min(n - 1 - 2 * allowed(n) for n in set(sizes[members].tolist())))
            entry = {"members": members, "size": high, "span": high + allowed(high), "need": need, "at": at}
            padded = np.zeros((len(members), high), np.int64)
            for row, m in enumerate(members):
                padded[row, : sizes[m]] = self.items[m]
                for key in (self.items[m][:-1] * self.base + self.items[m][1:]).tolist():
                    pairs[key] = pairs.get(key, 0) | 1 << g
            keys = self.walk(padded, at)
            order = np.argsort(keys, axis=1)
            entry["keys"], entry["order"] = np.take_along_axis(keys, order, 1), order
            self.groups.append(entry)
        self.pairs = np.array(sorted(pairs), np.int64)
        self.masks = np.array([pairs[k] for k in self.pairs.tolist()], np.uint64)
        self.widest = max((g["span"] for g in self.groups), default=0)
        self.least = min((g["need"] for g in self.groups), default=0)

    @staticmethod
    def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
        """A hash of each run of n words."""
        acc = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for k in range(n):
            acc = common.mix64(acc ^ words[k : len(words) - n + 1 + k].astype(np.uint64))
        return acc

    def search_exact(self, words: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, 0, first word, last word + 1) of the first place of every short item that the text holds word for word."""
        for n, (keys, members) in self.exact.items():
            if len(words) < n:
                continue
            runs = self.run_hashes(words, n)
            seen = set()
            for s in np.flatnonzero(np.isin(runs, keys)).tolist():
                for k in range(*np.searchsorted(keys, runs[s : s + 1], "left"), *np.searchsorted(keys, runs[s : s + 1], "right")):
                    item = int(members[k])
                    if item not in seen and np.array_equal(self.items[item], words[s : s + n]):
                        seen.add(item)
                        yield item, 0, s, s + n

    @staticmethod
    def walk(windows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(walks, windows): hash of each walk's sampled positions. Beyond its end a window reads as 0."""
        count, size = windows.shape
        flat = np.concatenate([windows, np.zeros((count, 1), np.int64)], axis=1).ravel().astype(np.uint64)
        rows = np.arange(count) * (size + 1)
        walks = np.arange(len(at), dtype=np.uint64)[:, None]
        pointer, acc = np.zeros((len(at), count), np.int64), np.repeat(common.mix64(walks), count, axis=1)
        for j in range(int(at.max(initial=-1)) + 1):
            word = flat[rows + np.minimum(pointer, size)]
            # a walk may sample a position twice
            for k in range(at.shape[1]):
                here = np.flatnonzero(at[:, k] == j)
                if len(here):
                    acc[here] = common.mix64(acc[here] ^ word[here])
            pointer += (common.mix64(word ^ (walks << np.uint64(40)) ^ np.uint64((j + 1) << 24)) & np.uint64(1)).astype(np.int64)
        return acc

    def dense(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(group, window starts) where a window holds enough of the group's word pairs."""
        if len(words) < MIN_WORDS - 1 or not len(self.pairs):
            return
        both = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
        if len(both) < self.least:
            return
        key = words[both] * self.base + words[both + 1]
        where = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[where] == key
        both, where = both[hit], where[hit]
        # enough pairs, of any group, within the widest window?
        k = self.least
        if len(both) < k or not (both[k - 1 :] - both[: len(both) - k + 1] < self.widest).any():
            return
        masks = self.masks[where]
        for g in range(len(self.groups)):
            span, need = self.groups[g]["span"], self.groups[g]["need"]
            own = both[(masks >> np.uint64(g)) & np.uint64(1) == 1]
            if len(own) < need or not (own[need - 1 :] - own[: len(own) - need + 1] < span).any():
                continue
            flags = np.zeros(len(words) + 1, np.int64)
            flags[own + 1] = 1
            total = np.cumsum(flags)
            starts = np.arange(len(words))
            ends = np.minimum(starts + span - 1, len(words))
            yield g, np.flatnonzero(total[ends] - total[starts] >= need)

    def search(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, first word, last word + 1) of the best stretch of every verified pair."""
        wanted: dict[int, list[tuple[int, np.ndarray]]] = {}
        for t, words in enumerate(texts):
            for g, starts in self.dense(words):
                wanted.setdefault(g, []).append((t, starts))
        candidates: dict[tuple[int, int], list[int]] = {}
        for g, found in wanted.items():
            entry = self.groups[g]
            owner = np.concatenate([np.full(len(s), t) for t, s in found])
            starts = np.concatenate([s for _, s in found])
            step = max(1, min(20_000, 480_000 // len(entry["at"]), 8_000_000 // entry["size"]))  # bounds memory
            for part in range(0, len(starts), step):
                self._bucket(entry, texts, owner[part : part + step], starts[part : part + step], candidates)
        out = [(t, *found) for t, words in enumerate(texts) for found in self.search_exact(words)] if self.exact else []
        for (t, item), starts in sorted(candidates.items()):
            if best := self._verify(texts[t], item, sorted(starts)):
                out.append((t, item, *best))
        return out

    def _bucket(self, entry, texts, owner, starts, candidates) -> None:
        size = entry["size"]
        windows = np.zeros((len(starts), size), np.int64)
        for row, (t, s) in enumerate(zip(owner.tolist(), starts.tolist(), strict=True)):
            cut = texts[t][s : s + size]
            windows[row, : len(cut)] = cut
        # repetitive texts have many equal windows
        windows, again = np.unique(windows, axis=0, return_inverse=True)
        keys = self.walk(windows, entry["at"])[:, again.ravel()]
        for r in range(len(keys)):
            low = np.searchsorted(entry["keys"][r], keys[r], "left")
            high = np.searchsorted(entry["keys"][r], keys[r], "right")
            for row in np.flatnonzero(high > low).tolist():
                for k in range(low[row], high[row]):
                    item = int(entry["members"][entry["order"][r][k]])
                    candidates.setdefault((int(owner[row]), item), []).append(int(starts[row]))

    def _verify(self, words: np.ndarray, item: int, starts: list[int]) -> tuple[int, int, int] | None:
        """(edits, first, last + 1) of the best stretch near the candidate starts, if close enough."""
        target = self.items[item]
        n, slack = len(target), allowed(len(target))
        for s in starts:
            if s + n <= len(words) and np.array_equal(words[s : s + n], target):
                return 0, s, s + n
        best, at, pattern = None, 0, target.tolist()
        while at < len(starts):
            # overlapping neighbourhoods are searched as one
            a = stop = starts[at]
            while at < len(starts) and starts[at] <= stop + n:
                stop = starts[at]
                at += 1
            a = max(0, a - slack)
            found = nearest(pattern, words[a : stop + n + 2 * slack + 1].tolist())
            if best is None or found[0] < best[0]:
                best = (found[0], a + found[1], a + found[2])
        return best if best and best[0] <= slack else None


def nearest(pattern: list[int], text: list[int]) -> tuple[int, int, int]:
    """(edits, first, last + 1) of the stretch of ``text`` nearest to ``pattern``: edit distance with free ends."""
    row = [(i, 0) for i in range(len(pattern) + 1)]
    best = (len(pattern), 0, 0)
    for k, word in enumerate(text, 1):
        before, row = row, [(0, k)]
        for i, p in enumerate(pattern):
            same = before[i] if p == word else (before[i][0] + 1, before[i][1])
            row.append(min(same, (before[i + 1][0] + 1, before[i + 1][1]), (row[i][0] + 1, row[i][1])))
        if row[-1][0] < best[0]:
            best = (row[-1][0], row[-1][1], k)
    return best


def recall(n: int, edits: int, trials: int = 200, seed: int = 1) -> float:
    """Share of random items of n words that are candidates after ``edits`` random word edits inside a longer text."""
    draw = np.random.default_rng(seed)
    found = 0
    for t in range(trials):
        item = [f"w{x}" for x in draw.integers(0, 5000, n)]
        bench = Benchmark([(0, " ".join(item))], seed=t)
        words = [bench.raw[w.encode()] for w in item]
        for _ in range(edits):
            at, kind = int(draw.integers(0, len(words))), int(draw.integers(0, 3))
            words[at : at + (kind != 0)] = [] if kind == 1 else [0]
        found += bool(bench.search([np.array([0] * 20 + words + [0] * 20, np.int64)]))
    return found / trials


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of about BLOCK rows, chosen by hash; the broadcasts of all blocks live as long as the plan."""
    count = max(1, -(-benchmark.count() // BLOCK))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield [(r.item_id, r.text) for r in benchmark.where(block == k).selectExpr("cast(item_id as long) item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, edits, item_words, first_word, last_word``: every document and item that it holds.

    Words are counted as the normalised words of the document, the last one exclusive.
    """
    common.ship(docs.sparkSession)
    schema = "doc_id long, item_id long, edits int, item_words int, first_word int, last_word int"
    texts, out = docs.select(F.col("doc_id").cast("long"), "text"), None
    for items in _blocks(benchmark):
        found = texts.mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(items)), schema)
        out = found if out is None else out.union(found)
    return out


def _read(bench: Benchmark, column: pa.Array) -> list[np.ndarray]:
    """The benchmark's word ids of each text."""
    texts = []
    for text in common.byte_texts(column):
        cut = text.split()
        words = np.fromiter(map(bench.raw.__getitem__, cut), np.int64, len(cut))
        texts.append(words[words >= 0])
    return texts


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = _prepared(shared.value)
        common.only(bench.raw)
        for whole in batches:
            for batch in common.slices(whole, 8_000_000):
                found = bench.search(_read(bench, batch.column(1)))
                if found:
                    t, item, edits, first, last = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(t)), pa.array([bench.ids[i] for i in item], pa.int64()), pa.array(edits, pa.int32()),
                            pa.array([len(bench.items[i]) for i in item], pa.int32()), pa.array(first, pa.int32()), pa.array(last, pa.int32()),
                        ],
                        ["doc_id", "item_id", "edits", "item_words", "first_word", "last_word"],
                    )

    return run


_PREPARED: dict[int, Benchmark] = {}


def _prepared(items: list[tuple[int, str | None]], least_words: int = 1) -> Benchmark:
    """The block's search structure, made once per worker process."""
    key = hash((least_words, *items))
    if key not in _PREPARED:
        _PREPARED.clear()
        _PREPARED[key] = Benchmark(items, least_words=least_words)
    return _PREPARED[key]


def clean(docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns: a narrow filter for each block of items.

    Items of fewer than ``least_words`` words drop nothing: one or two words ("New York") stand in many clean texts.
    """
    common.ship(docs.sparkSession)
    names = docs.columns
    at = names.index("text")

    def keeper(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = _prepared(shared.value, least_words)
            common.only(bench.raw)
            for whole in batches:
                for batch in common.slices(whole, 8_000_000, at):
                    keep = np.ones(batch.num_rows, bool)
                    keep[[t for t, *_ in bench.search(_read(bench, batch.column(at)))]] = False
                    yield batch.filter(pa.array(keep))

        return run

    for items in _blocks(benchmark):
        docs = docs.mapInArrow(keeper(docs.sparkSession.sparkContext.broadcast(items)), docs.schema)
    return docs
