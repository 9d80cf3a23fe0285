"""BPE encoding and decoding by speculation and verification.

A pre-token is first cut greedily into the longest vocabulary entries. That guess is what byte-pair merging gives
exactly when every proposed token is what merging makes of its own text, and no merge would ever cross the border
of two adjacent tokens. Both are tested for whole batches of tokens and token pairs with numpy; only the pre-tokens
that fail are merged pair by pair.

Edge cases: null and empty texts, and texts of white space only, have no ids and decode to ''. Special-token
strings in a text become their ids. A text of any length is one row; memory is bounded by one Arrow batch and a
memo of ``CACHE`` words.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sectora.llm import common

CACHE = 500_000
NEVER = np.int64(2**62)
SHORT = 40
NO_RULE = (2**62, -1)

# The pre-token pattern of the vocabulary file (its white space spelled out) and the byte alphabet rule.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0  -     　\p{L}\p{N}]+"


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next code point from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    """One vocabulary file: encoder and decoder of single texts and of batches of words."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pretoken = regex.compile(PRETOKEN)
        self.alphabet = byte_alphabet()
        self.longest = max(map(len, self.vocab))
        size = max(self.token) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        right = np.array([self.vocab[b] for _, b in merges], np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges), dtype=np.int64)
        self.size = size
        self.rule = {(int(a), int(b)): (r, int(c)) for r, (a, b, c) in enumerate(zip(left, right, made, strict=True))}
        order = np.argsort(left * size + right)
        self.pair_key, self.pair_rank = (left * size + right)[order], rank[order]
        #: Of each token: the rank of the merge that makes it (-1: a single symbol) and its two parts.
        self.rank, self.first, self.second = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        seen = np.unique(made, return_index=True)[1]
        self.rank[made[seen]], self.first[made[seen]], self.second[made[seen]] = rank[seen], left[seen], right[seen]
        grows = bool(np.all(np.maximum(self.rank[left[seen]], self.rank[right[seen]]) < rank[seen]))
        #: A token is sound if merging its own text gives it; the border test needs ranks that grow upwards.
        self.sound = np.zeros(size, bool)
        self.sound[[i for t, i in self.vocab.items() if len(t.removesuffix(self.end) or t) == 1]] = grows
        if grows:
            inner = self.borders_hold(left[seen], right[seen], rank[seen])
            for c, a, b, ok in zip(made[seen].tolist(), left[seen].tolist(), right[seen].tolist(), inner.tolist(), strict=True):
                self.sound[c] = ok and self.sound[a] and self.sound[b]
        self.known: dict[bytes, int] = {}
        self.pieces: dict[str, list[int]] = {}
        self._reset()

    # -- speculation and verification -------------------------------------------------------------------------

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], NEVER)

    def borders_hold(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For adjacent tokens a, b: would no merge ever join symbols across their border (before rank ``limit``)?

        Time runs backwards from the finished tokens: the symbols beside the border are compared, then the younger
        one is taken apart. Equal ranks are merged from the left, so the right-hand one is the younger, and a merge
        across the border loses against an equal one on its left but wins against one on its right.
        """
        a, b = a.copy(), b.copy()
        hold, live = np.ones(len(a), bool), np.arange(len(a))
        bound = np.full(len(a), NEVER - 1) if limit is None else limit.copy()
        while len(live):
            x, y = a[live], b[live]
            crossed = self._rank_of(x, y) < bound[live]
            hold[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            of_left = rx > ry
            a[live] = np.where(of_left, self.second[x], x)
            b[live] = np.where(of_left, y, self.first[y])
            bound[live] = np.minimum(bound[live], np.where(of_left, rx, ry + 1))
        return hold

    def propose(self, symbols: str) -> list[int]:
        """Longest match from the left; the last token must carry the end mark."""
        out, at, n, vocab = [], 0, len(symbols), self.vocab
        while at < n:
            whole = vocab.get(symbols[at:] + self.end)
            if whole is not None:
                out.append(whole)
                break
            for stop in range(min(n - 1, at + self.longest), at, -1):
                if (found := vocab.get(symbols[at:stop])) is not None:
                    out.append(found)
                    at = stop
                    break
        return out

    def merge(self, symbols: str) -> list[int]:
        """Exact merging: always the pair of lowest rank, from the left."""
        ids = [self.vocab[s] for s in symbols[:-1]] + [self.vocab[symbols[-1] + self.end]]
        return self._merge_long(ids) if len(ids) > SHORT else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rule = self.rule
        offers = [rule.get(p, NO_RULE) for p in zip(ids, ids[1:], strict=False)]
        while offers:
            best = min(offers)
            if best is NO_RULE:
                break
            i = offers.index(best)
            ids[i : i + 2] = [best[1]]
            del offers[i]
            if i:
                offers[i - 1] = rule.get((ids[i - 1], ids[i]), NO_RULE)
            if i < len(offers):
                offers[i] = rule.get((ids[i], ids[i + 1]), NO_RULE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for runs of any length."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < len(ids) and (r := self.rule.get((ids[i], ids[j]))):
                heapq.heappush(heap, (r[0], i, ids[i], ids[j], r[1]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, x, y, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j >= len(ids) or ids[j] != y:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def encode_pretokens(self, pretokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token (normalised text): proposed together, verified together, merged where wrong."""
        symbols = ["".join(map(self.alphabet.__getitem__, p.encode())) for p in pretokens]
        guesses = [self.propose(s) for s in symbols]
        lengths = np.fromiter(map(len, guesses), np.int64, len(guesses))
        flat = np.fromiter((i for g in guesses for i in g), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(guesses)), lengths)
        wrong = np.zeros(len(guesses), bool)
        wrong[owner[~self.sound[flat]]] = True
        inside = np.flatnonzero(owner[:-1] == owner[1:]) if len(flat) > 1 else np.zeros(0, np.int64)
        pairs, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        hold = self.borders_hold(pairs // self.size, pairs % self.size)
        wrong[owner[inside[~hold[back]]]] = True
        for i in np.flatnonzero(wrong).tolist():
            guesses[i] = self.merge(symbols[i])
        return guesses

    # -- words and texts --------------------------------------------------------------------------------------

    def pretokens(self, word: bytes) -> list[str | int]:
        """Pre-tokens of a run without ASCII white space; special tokens as their ids."""
        text, out = word.decode("utf-8", "replace"), []
        for part in self.special_re.split(text) if self.special_re and "<" in text else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                # one code point at a time, so a capital sigma has one small form
                out += self.pretoken.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def clear(self) -> None:
        """Forget all words and pre-tokens."""
        self.pieces.clear()
        self._reset()

    def _reset(self) -> None:
        self.known.clear()
        self.starts, self.counts, self.flat, self.fill = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0

    def learn(self, new: list[bytes]) -> None:
        """Encode distinct new words in one go and keep them in the memo."""
        cut = [self.pretokens(w) for w in new]
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        ids = self.pieces
        plain = list({p: None for c in cut for p in c if isinstance(p, str) and p not in ids})
        if plain:
            ids.update(zip(plain, self.encode_pretokens(plain), strict=True))
        for word, parts in zip(new, cut, strict=True):
            made = [i for p in parts for i in (ids[p] if isinstance(p, str) else (p,))]
            slot = len(self.known)
            if slot >= len(self.starts):
                self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
            while self.fill + len(made) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.flat[self.fill : self.fill + len(made)] = made
            self.starts[slot], self.counts[slot] = self.fill, len(made)
            self.fill += len(made)
            self.known[word] = slot

    def encode_all(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids (uint32) of each whole text; the new words of all texts are learnt together."""
        cuts = [t.split() for t in texts]
        if len(self.known) > CACHE:
            self._reset()
        known = self.known
        new = {w for cut in cuts for w in cut if w not in known}
        if new:
            self.learn(list(new))
        for cut in cuts:
            slots = np.fromiter(map(known.__getitem__, cut), np.int64, len(cut))
            counts = self.counts[slots]
            ends = np.cumsum(counts)
            where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[slots] - (ends - counts), counts)
            yield self.flat[where]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids, joined by spaces: the vocabulary file names no decoder."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


_LOADED: dict[str, WordBpe] = {}


def loaded(spec: str) -> WordBpe:
    """The vocabulary, parsed once per worker process."""
    key = hashlib.sha1(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = common.memo(WordBpe(spec))
    return _LOADED[key]


def encode_decode(docs: DataFrame, vocabulary: str, extra: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, and those of ``ids, decoded`` named in ``extra``.

    ``vocabulary`` is the path of a tokenizer file that the driver can read; its text (under 2 MB) goes to the
    executors as a broadcast. One narrow pass over (doc_id, text): no shuffle, and repeated rows give equal rows.
    """
    spark = docs.sparkSession
    common.ship(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        common.only(bpe)
        for whole in batches:
            for batch in common.slices(whole):
                rows, more = [], {name: [] for name in extra}
                for ids in bpe.encode_all(list(common.byte_texts(batch.column(1)))):
                    back = bpe.decode(ids)
                    rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
                    for name, values in more.items():
                        values.append(ids.astype(np.int32) if name == "ids" else back)
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]
                cols += [pa.array(v, pa.list_(pa.int32()) if name == "ids" else pa.string()) for name, v in more.items()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *extra])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join({"ids": ", ids array<int>", "decoded": ", decoded string"}[x] for x in extra)
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
