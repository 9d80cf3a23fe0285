"""Scores of whole texts by a gated recurrent language model with a class-factored softmax.

Counting. Tokens are words with ASCII letters lower-cased, then one end token. All training texts are counted: each
task sums its own tokens, the counts meet by token hash (64 bits), and stay a table.

Model. The ``VOCABULARY`` most frequent tokens are predicted one by one, the others by a class of their form
(alphabet, ending) and their add-one share of that class:

    P(word | state) = P(class | state) * P(word | class, state)     for a frequent word
    P(word | state) = P(class | state) * (c + 1) / (N_class + V_class + 1)    for another, c = 0 if never seen

Frequent words are divided into classes of equal square-root frequency. The output biases start at the logarithms
of the corpus frequencies, so an untrained model is the class unigram. The state comes from a gated recurrent unit in
numpy: texts lie in ``LANES`` parallel lanes, the gradient runs back over windows of ``WINDOW`` tokens, and the
state is carried from window to window within a text and is zero at its start. In training every window takes a
gradient step, and texts are learnt in pieces of ``TRAINED`` tokens, all of them; a scored text is never cut.

Training. ``EPOCHS`` passes over the ``START`` training texts of smallest id hash (a bound) bring all tasks to one
basin; then in each of ``ROUNDS`` rounds every task goes on from the same weights over its own training texts, and the
weights are averaged by tokens seen. Each training text is used in one round. Averages are sums over batches in two
levels, so nobody holds more than two sets of weights at a time, however many tasks there are.

Scoring. One pass runs every whole text through the model. Counts of the ``HEAD`` most frequent tokens are
broadcast (a fixed bound); of the rest only (row, token hash, number) is shuffled to the table of counts. The sums
over a hot token's rows are spread by the join, which Spark splits.

Edge cases: a null or empty text is just the end token. With no training text all counts are 0 and the model is
uniform over its classes. Repeated rows count and score each on their own (equal up to single precision). An empty table gives no rows. Memory is
bounded by a slice of about ``SLICE`` bytes of text, or one text.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

VOCABULARY, HEAD, CLASSES = 2048, 200_000, 12
WIDTH, EMBEDDING, WINDOW, LANES = 16, 16, 16, 192
#: Scoring takes no steps, so its lanes and windows only fit the caches.
SCORE_LANES, SCORE_WINDOW = 512, 16
#: Training texts are learnt in pieces of this many tokens, each from the zero state; a scored text is one piece.
TRAINED = 2048
START, EPOCHS, ROUNDS, RATE = 1500, 3, 2, 0.08
AVERAGERS = 16
SLICE = 16_000_000
#: Words are cut and looked up for about this many bytes of text at a time.
READ = 4_000_000
FLUSH = 800_000

END = common.word_hash(b"\n")  # no token holds white space
_SIGNED = 1 << 64

# Letters beyond ASCII that mark an alphabet, as UTF-8.
_GERMANIC = tuple("äöüß".encode()[k : k + 2] for k in range(0, 8, 2))
_IBERIAN = tuple("ñóíáú".encode()[k : k + 2] for k in range(0, 10, 2))
FORMS = 64


#: Kind of a word's last character, by its byte: letter, punctuation, digit, other.
_ENDING = bytes(0 if 97 <= b <= 122 or b >= 128 else 1 if b in b".,;:?" else 2 if 48 <= b <= 57 else 3 for b in range(256))
_PUNCTUATION = b".,;:?!#*$%&|<>\"')"


def form(word: bytes) -> int:
    """The form class of a word: alphabet (4) x last character (4) x its last letters (4)."""
    if word.isascii():
        alphabet = 0
    elif any(x in word for x in _GERMANIC):
        alphabet = 16
    elif any(x in word for x in _IBERIAN):
        alphabet = 32
    else:
        alphabet = 48
    return alphabet + 4 * _ENDING[word[-1]] + sum(word.rstrip(_PUNCTUATION)[-2:]) % 4


def _holding(marks: tuple[bytes, ...], data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word holds one of the two-byte letters."""
    pair = data[:-1].astype(np.uint16) << 8 | data[1:]
    seen = np.concatenate([[0], np.cumsum(np.isin(pair, [int.from_bytes(m) for m in marks]))])
    return seen[np.maximum(ends - 1, starts)] > seen[starts]


def forms(words: list[bytes]) -> np.ndarray:
    """``form`` of all words at once; none is empty."""
    data, sizes = np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
    if not len(data):
        return np.zeros(0, np.int32)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    ending, letters = np.frombuffer(_ENDING, np.uint8)[data[ends - 1]].astype(np.int32), np.zeros(len(words), np.int32)
    mark, stop = np.isin(np.arange(256), np.frombuffer(_PUNCTUATION, np.uint8)), ends.copy()
    left = np.flatnonzero(mark[data[ends - 1]])
    while len(left):
        stop[left] -= 1
        left = left[stop[left] > starts[left]]
        left = left[mark[data[stop[left] - 1]]]
    for back in (1, 2):
        letters += np.where(stop - back >= starts, data[np.maximum(stop - back, 0)], 0)
    beyond = np.concatenate([[0], np.cumsum(data >> 7, dtype=np.int64)])
    other = np.flatnonzero(beyond[ends] > beyond[starts])
    alphabet = np.zeros(len(words), np.int32)
    if len(other):
        at, to = starts[other], ends[other]
        alphabet[other] = np.where(_holding(_GERMANIC, data, at, to), 16, np.where(_holding(_IBERIAN, data, at, to), 32, 48))
    return alphabet + 4 * ending + letters % 4


def _signed(h: int) -> int:
    return h - _SIGNED if h >= _SIGNED >> 1 else h


def _hashes(words: list[bytes]) -> np.ndarray:
    """``common.word_hash`` of the words, as signed longs."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _described(word: bytes) -> tuple[int, int]:
    """(hash as a signed long, form class)."""
    return _signed(common.word_hash(word)), form(word)


def held_out(column: str = "doc_id") -> Column:
    return common.crc_mod(column, 7) == 2


def _listed(words: pa.Array) -> list[bytes]:
    """The bytes of an unsliced string array's values, cut from its buffer."""
    _, offsets, data = words.buffers()
    if not len(words) or data is None:
        return [b""] * len(words)
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(words.type) else np.int32, len(words) + 1)
    raw, at = data.to_pybytes(), at.tolist()
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def cut(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(number of words of each text, place of each word in the last list, distinct words), A-Z in lower case."""
    # both functions know ASCII only, as bytes.lower and bytes.split do
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    words, codes = _listed(coded.dictionary), coded.indices.to_numpy()
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy()
    if b"" in words:  # before white space at the beginning, and after white space at the end
        empty = words.index(b"")
        del words[empty]
        lengths = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[codes != empty], minlength=len(lengths))
        codes = codes[codes != empty]
        codes = codes - (codes > empty)
    return lengths, codes, words


# -- counting ------------------------------------------------------------------------------------------------------


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, form, n) of several lists as one, each token once."""
    tokens, kinds, numbers = (np.concatenate(x) for x in zip(*parts, strict=True))
    tokens, first, place = np.unique(tokens, return_index=True, return_inverse=True)
    # counts of a task stay far below 2 ** 53
    return tokens, kinds[first], np.bincount(place, numbers, len(tokens)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ends = size = 0

    def flush():
        for tokens, kinds, numbers in [_summed(held)] if held else []:
            for at in range(0, len(tokens), 50_000):
                part = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[part]), pa.array(kinds[part]), pa.array(numbers[part])], ["token", "form", "n"])
        held.clear()

    for whole in batches:
        for batch in common.slices(whole, READ):
            _, codes, words = cut(batch.column(1))
            held.append((_hashes(words), forms(words), np.bincount(codes, minlength=len(words))))
            size += len(words)
            ends += batch.num_rows
            if size > FLUSH:
                # what repeats between texts is summed here, and only what doesn't is sent on
                held[:] = [_summed(held)]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield from flush()
                    size = 0
    yield from flush()
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array([_signed(END)], pa.int64()), pa.array([-1], pa.int32()), pa.array([ends], pa.int64())], ["token", "form", "n"])


def count_tokens(texts: DataFrame) -> DataFrame:
    """``token, form, c`` of every distinct token of (doc_id, text), written; the end token has form -1."""
    parts = texts.mapInArrow(_count, "token long, form int, n long")
    return common.written(parts.groupBy("token").agg(F.min("form").alias("form"), F.sum("n").alias("c")), "token-counts")


class Vocabulary:
    """Totals, the broadcast counts, and the division into classes; bounded by HEAD and FORMS."""

    def __init__(self, counts: DataFrame):
        by_form = counts.groupBy("form").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
        self.n, self.v = sum(r.n for r in by_form), sum(r.v for r in by_form)
        # a threshold that leaves HEAD tokens at most: as many rows as there are different counts
        above, least = 0, None
        for r in counts.groupBy("c").agg(F.count("*").alias("k")).orderBy(F.desc("c")).limit(HEAD).collect():
            if above + r.k > HEAD:
                break
            above, least = above + r.k, r.c
        self.least = least if least is not None else 1 << 62
        head = counts.where(F.col("c") >= self.least).toPandas().sort_values(["c", "token"], ascending=[False, True])
        order = np.argsort(head.token.to_numpy())
        self.tokens, self.counts = head.token.to_numpy()[order], head.c.to_numpy()[order]
        model = head[head.token != _signed(END)].head(VOCABULARY - 1)
        ends = int(head.c[head.token == _signed(END)].sum())
        self.texts = ends
        #: Predicted words by falling frequency, the end token first: (hash, count)
        self.words = np.concatenate([[_signed(END)], model.token.to_numpy()]).astype(np.int64)
        frequency = np.concatenate([[ends], model.c.to_numpy()]).astype(np.float64)
        mass = np.cumsum(np.sqrt(frequency + 1))
        division = np.minimum((mass - mass[0] / 2) * CLASSES / mass[-1], CLASSES - 1).astype(np.int64)
        division = np.unique(division, return_inverse=True)[1]
        self.class_of, self.sizes = division, np.bincount(division)
        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.starts, self.place = starts, np.arange(len(division)) - starts[division]
        #: Tokens and types of each form class, without the predicted words
        self.form_n, self.form_v = np.zeros(FORMS), np.zeros(FORMS)
        for r in by_form:
            if r.form >= 0:
                self.form_n[r.form], self.form_v[r.form] = r.n, r.v
        np.subtract.at(self.form_n, model.form.to_numpy(np.int64), model.c.to_numpy(np.float64))
        np.subtract.at(self.form_v, model.form.to_numpy(np.int64), 1.0)
        self.word_bias = np.log((frequency + 1) / np.bincount(division, frequency + 1)[division]).astype(np.float32)
        classes = np.concatenate([np.bincount(division, frequency + 1), self.form_n + self.form_v + 1])
        self.class_bias = np.log(classes / classes.sum()).astype(np.float32)
        self.share = np.log10(self.form_n + self.form_v + 1)
        self.base = math.log10(self.n + self.v + 1)


class Reader:
    """Turns texts into places in a list of their distinct words, with each word's model id, its log10(c + 1) if that is
    broadcast (else 0), and its hash.

    A model id is the place of a predicted word, or VOCABULARY + form class.
    """

    def __init__(self, vocabulary: Vocabulary):
        order = np.argsort(vocabulary.words)
        self.model_hashes, self.model_ids = vocabulary.words[order], order.astype(np.int32)
        self.tokens, self.token_logs = vocabulary.tokens, np.log10(vocabulary.counts + 1.0)
        self.ids, self.logs, self.hashes = np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64)

    def meet(self, words: list[bytes]) -> None:
        """Look up all words at once."""
        self.hashes = hashes = _hashes(words)
        at = np.minimum(np.searchsorted(self.model_hashes, hashes), len(self.model_hashes) - 1)
        self.ids = np.where(self.model_hashes[at] == hashes, self.model_ids[at], VOCABULARY + forms(words))
        self.logs = np.zeros(len(words))
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, hashes), len(self.tokens) - 1)
            self.logs = np.where(self.tokens[at] == hashes, self.token_logs[at], 0.0)

    def read(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The words' places, and the model ids of the words and the end token (0)."""
        return next(self.read_all(pa.array([text.decode()])))

    def read_all(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``read`` of several texts; the places hold until the next call."""
        lengths, codes, words = cut(texts)
        self.meet(words)
        ids, at = self.ids[codes], 0
        for n in lengths.tolist():
            yield codes[at : at + n], np.append(ids[at : at + n], np.int32(0))
            at += n


# -- the network ---------------------------------------------------------------------------------------------------


def initial(v: Vocabulary, seed: int = 7) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)

    def normal(*shape):
        return (draw.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)

    return {
        "emb": (draw.standard_normal((VOCABULARY + FORMS, EMBEDDING)) * 0.3).astype(np.float32),
        "wx": normal(EMBEDDING, 3 * WIDTH), "bx": np.zeros(3 * WIDTH, np.float32), "wh": normal(WIDTH, 3 * WIDTH),
        "wc": normal(WIDTH, len(v.class_bias)) * np.float32(0.1), "bc": v.class_bias.copy(),
        "wo": normal(WIDTH, len(v.words)) * np.float32(0.1), "bo": v.word_bias.copy(),
    }


def packed(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w)])


def unpacked(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def lanes(texts: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(targets, inputs, owners), each (steps, lanes): texts one after another in the least filled lane.

    Unused places have owner -1; lanes are ordered by falling length. A text's first input is the end token (0).
    """
    count = max(1, min(most, len(texts)))
    fill, heap = [[] for _ in range(count)], [(0, k) for k in range(count)]
    for t in sorted(range(len(texts)), key=lambda t: -len(texts[t])):
        load, k = heap[0]
        fill[k].append(t)
        heapq.heapreplace(heap, (load + len(texts[t]), k))
    fill.sort(key=lambda lane: -sum(len(texts[t]) for t in lane))
    steps = sum(len(texts[t]) for t in fill[0])
    # a lane's steps lie side by side, as its texts are copied whole; a window is small enough to be turned
    target, source, owner = np.zeros((count, steps), np.int32), np.zeros((count, steps), np.int32), np.full((count, steps), -1, np.int32)
    for k, lane in enumerate(fill):
        at = 0
        for t in lane:
            n = len(texts[t])
            target[k, at : at + n], owner[k, at : at + n] = texts[t], t
            source[k, at + 1 : at + n] = texts[t][:-1]
            at += n
    return target.T, source.T, owner.T


def _joined(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The bias as a last row of the weights: it is added by the product with a last column of ones."""
    return np.concatenate([weights, bias[None]])


def _with_ones(rows: np.ndarray) -> np.ndarray:
    out = np.ones((*rows.shape[:-1], rows.shape[-1] + 1), rows.dtype)
    out[..., :-1] = rows
    return out


def _exponents(x: np.ndarray, bound: float) -> np.ndarray:
    """exp(x) in place, each row scaled by its maximum unless ``bound`` rules an overflow out."""
    if not bound < 60:
        x -= x.max(axis=1, keepdims=True)
    return np.exp(x, out=x)


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _log_at(x: np.ndarray, at: np.ndarray, bound: float) -> np.ndarray:
    """The logarithm of each row's probability at one place; x is used up."""
    if not bound < 60:
        x -= x.max(axis=1, keepdims=True)
    chosen = x[np.arange(len(x)), at]
    return chosen - np.log(_row_sums(np.exp(x, out=x)))


def _slopes(x: np.ndarray, at: np.ndarray, bound: float, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The softmax gradient of outputs x (used up) for targets ``at``, times ``scale``, as (matrix, factor of each row)."""
    x = _exponents(x, bound)
    sums = _row_sums(x)
    x[np.arange(len(x)), at] -= sums
    return x, (scale / sums)[:, None]


def _bound(weights: np.ndarray) -> float:
    """No output by these joined weights exceeds this, as states lie between -1 and 1."""
    return float(np.abs(weights).sum(axis=0).max()) if weights.size else 0.0


def _classes(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    return np.where(ids < VOCABULARY, v.class_of[np.minimum(ids, len(v.class_of) - 1)], len(v.sizes) + ids - VOCABULARY)


def _by_class(v: Vocabulary, cls: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(class, rows whose target is one of its words), for classes of predicted words that occur; ``cls`` rises."""
    cuts = np.searchsorted(cls, np.arange(len(v.sizes) + 1)).tolist()
    for k in range(len(v.sizes)):
        if cuts[k + 1] > cuts[k] and v.sizes[k] > 1:
            yield k, slice(cuts[k], cuts[k + 1])


def log_probabilities(v: Vocabulary, w: dict[str, np.ndarray], h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(class | state), times P(word | class, state) for predicted words."""
    cls = _classes(v, ids)
    order = np.argsort(cls.astype(np.int16), kind="stable")
    out = np.empty(len(ids), h.dtype)
    out[order] = _logs_in_order(v, _joined(w["wc"], w["bc"]), _joined(w["wo"], w["bo"]), _with_ones(h)[order], ids[order], cls[order])
    return out


def _logs_in_order(v: Vocabulary, of_class: np.ndarray, of_word: np.ndarray, h: np.ndarray, ids: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """``log_probabilities`` by joined weights, for states with a one behind, in order of their targets' classes."""
    out = _log_at(h @ of_class, cls, _bound(of_class))
    most, place = _bound(of_word), v.place[np.minimum(ids, len(v.place) - 1)]
    for k, rows in _by_class(v, cls):
        out[rows] += _log_at(h[rows] @ of_word[:, v.starts[k] : v.starts[k + 1]], place[rows], most)
    return out


def _halved(weights: np.ndarray) -> np.ndarray:
    """The recurrent unit's weights, turned; those of its gates halved, as sigmoid(x) = tanh(x / 2) / 2 + 1 / 2."""
    out = weights.T.copy()
    out[: 2 * WIDTH] *= 0.5
    return out


def _kept(owner: np.ndarray, before: np.ndarray, dtype) -> np.ndarray:
    """1 where a step goes on with the text of the step before, else 0."""
    return (owner == np.concatenate([before[None], owner[:-1]])).astype(dtype)


def _advance(x, inward, kept, h, states) -> np.ndarray:
    """Run the recurrent unit over a window's steps, filling ``states``; the state is carried within a text only.

    All arrays hold a row for each feature, a column for each lane: parts of the features lie side by side.
    """
    g, n = np.empty(x.shape[1:], x.dtype), np.empty(h.shape, x.dtype)
    gates, inner, z, r = g[: 2 * WIDTH], g[2 * WIDTH :], g[:WIDTH], g[WIDTH : 2 * WIDTH]
    whole = kept.all(axis=1).tolist()
    for t in range(len(x)):
        if not whole[t]:
            h = h * kept[t]
        np.matmul(inward, h, out=g)
        gates += x[t, : 2 * WIDTH]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(r, inner, out=n)
        n += x[t, 2 * WIDTH :]
        np.tanh(n, out=n)
        # n + z * (h - n)
        to = np.subtract(h, n, out=states[t])
        to *= z
        to += n
        h = to
    return h


def _windows(owner: np.ndarray, size: int, rows: int = 0) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(first step, last + 1, lanes still in use, owners of the step before) of consecutive windows of ``size`` steps, or of as many
    as hold ``rows`` places, where few lanes are left."""
    live, at = (owner >= 0).sum(axis=0), 0
    while at < len(owner):
        count = int((live > at).sum())
        stop = min(len(owner), at + max(size, rows // count))
        yield at, stop, count, owner[at - 1, :count] if at else np.full(count, -2, np.int32)
        at = stop


def score_texts(v: Vocabulary, w: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the model's part of each text's probability: all but the shares inside form classes."""
    target, source, owner = lanes(texts, SCORE_LANES)
    words, inputs, inward = _with_ones(w["emb"]), _halved(_joined(w["wx"], w["bx"])), _halved(w["wh"])
    of_class, of_word = _joined(w["wc"], w["bc"]), _joined(w["wo"], w["bo"])
    out = np.zeros(len(texts))
    h = np.zeros((WIDTH, target.shape[1]), words.dtype)
    for at, stop, count, before in _windows(owner, SCORE_WINDOW, SCORE_WINDOW * SCORE_LANES):
        own = np.ascontiguousarray(owner[at:stop, :count])
        x = inputs @ words[source[at:stop, :count]].transpose(0, 2, 1)
        states = np.empty((stop - at, WIDTH, count), words.dtype)
        h = _advance(x, inward, _kept(own, before, words.dtype), h[:, :count], states)
        own, ids = own.ravel(), target[at:stop, :count].ravel()
        real = np.flatnonzero(own >= 0)
        cls = _classes(v, ids[real]).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        real = real[order]
        logs = _logs_in_order(v, of_class, of_word, _with_ones(states.transpose(0, 2, 1)).reshape(-1, WIDTH + 1)[real], ids[real], cls[order])
        out += np.bincount(own[real], logs.astype(np.float64), len(texts))
    return out / math.log(10)


class Trainer:
    """Adagrad over windows of WINDOW steps; the state at a window's start is a constant to its gradient."""

    def __init__(self, v: Vocabulary, w: dict[str, np.ndarray], square: dict[str, np.ndarray] | None = None):
        self.v, self.w = v, {k: x.copy() for k, x in w.items()}
        self.square = {k: square[k].copy() if square else np.full(x.shape, 1e-3, np.float32) for k, x in w.items()}
        #: Weights with their bias, and embeddings with a one; ``w`` holds views of them.
        self.joined = {}
        for weights, bias in (("wx", "bx"), ("wc", "bc"), ("wo", "bo")):
            self.joined[weights] = both = _joined(w[weights], w[bias])
            self.w[weights], self.w[bias] = both[:-1], both[-1]
        self.words = _with_ones(w["emb"])
        self.w["emb"] = self.words[:, :-1]
        self.tokens = 0

    def _update(self, name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        g = np.clip(gradient, -1, 1)
        self.square[name][rows] += g * g
        self.w[name][rows] -= RATE * g / np.sqrt(self.square[name][rows])

    def learn(self, texts: list[np.ndarray]) -> None:
        # pieces of a long text lie side by side, or it would hold up a few lanes long after the others are done
        texts = [t[at : at + TRAINED] for t in texts for at in range(0, len(t), TRAINED)]
        target, source, owner = lanes(texts, LANES)
        h = np.zeros((WIDTH, target.shape[1]), self.words.dtype)
        for at, stop, count, before in _windows(owner, WINDOW):
            h = self._window(target[at:stop, :count], source[at:stop, :count], owner[at:stop, :count], before, h[:, :count])
        self.tokens += int((owner >= 0).sum())

    def _window(self, target, source, owner, before, h):
        w, v, size, dtype = self.w, self.v, WIDTH, self.words.dtype
        steps, count = target.shape
        target, source, owner = target.ravel(), source.ravel(), np.ascontiguousarray(owner)
        # a row for each feature, a column for each lane: parts of the features lie side by side
        embedded = self.words[source].reshape(steps, count, -1).transpose(0, 2, 1)
        x, inward, kept = _halved(self.joined["wx"]) @ embedded, _halved(w["wh"]), _kept(owner, before, dtype)
        entered, news, apart, states = np.empty((4, steps, size, count), dtype)
        g = np.empty((steps, 3 * size, count), dtype)
        gates, inner, z, r = g[:, : 2 * size], g[:, 2 * size :], g[:, :size], g[:, size : 2 * size]
        for t in range(steps):
            np.multiply(h, kept[t], out=entered[t])
            np.matmul(inward, entered[t], out=g[t])
            both, new = gates[t], news[t]
            both += x[t, : 2 * size]
            np.tanh(both, out=both)
            both *= 0.5
            both += 0.5
            np.multiply(r[t], inner[t], out=new)
            new += x[t, 2 * size :]
            np.tanh(new, out=new)
            # new + z * (entered - new)
            np.subtract(entered[t], new, out=apart[t])
            h = np.multiply(z[t], apart[t], out=states[t])
            h += new
        # output layer, all steps at once; gradients are means over the window's real tokens, times a lane count
        real = np.flatnonzero(owner.ravel() >= 0)
        scale = dtype.type(1.0 / max(1, count))
        cls = _classes(v, target[real]).astype(np.int16)
        order = np.argsort(cls, kind="stable")
        real, cls = real[order], cls[order]
        flat, ids = _with_ones(states.transpose(0, 2, 1)).reshape(-1, size + 1)[real], target[real]
        of_class, of_word = self.joined["wc"], self.joined["wo"]
        p, factor = _slopes(flat @ of_class, cls, _bound(of_class), scale)
        up, out_c, out_w = p @ w["wc"].T, p.T @ (flat * factor), np.zeros_like(of_word.T)
        up *= factor
        most, place = _bound(of_word), v.place[np.minimum(ids, len(v.place) - 1)]
        for k, rows in _by_class(v, cls):
            part, own = slice(v.starts[k], v.starts[k + 1]), flat[rows]
            q, factor = _slopes(own @ of_word[:, part], place[rows], most, scale)
            up[rows] += (q @ w["wo"][:, part].T) * factor
            np.matmul(q.T, own * factor, out=out_w[part])
        above = np.zeros((steps * count, size), dtype)
        above[real] = up
        above = np.ascontiguousarray(above.reshape(steps, count, size).transpose(0, 2, 1))
        # back through the window; all that doesn't depend on the later steps is made at once
        first, then = np.empty((2, steps, 2, size, count), dtype)
        rest = 1 - z
        np.multiply(rest, 1 - news * news, out=first[:, 0])
        np.multiply(apart, z * rest, out=first[:, 1])
        np.multiply(inner, r * (1 - r), out=then[:, 0])
        then[:, 1] = r
        # of the new state, the gates z and r, and what the state adds to the new state
        down, back = np.zeros((size, count), dtype), np.empty((steps, 4, size, count), dtype)
        flows = back[:, 1:].reshape(steps, 3 * size, count)
        for t in range(steps - 1, -1, -1):
            dh = above[t]
            dh += down
            np.multiply(dh, first[t], out=back[t, :2])
            np.multiply(back[t, 0], then[t], out=back[t, 2:])
            np.matmul(w["wh"], flows[t], out=down)
            dh *= z[t]
            down += dh
            down *= kept[t]
        dwh = (entered @ flows.transpose(0, 2, 1)).sum(axis=0)
        # inputs: new state, z, r; the weights' order is z, r, new state
        flows, turn = back[:, :3].reshape(steps, 3 * size, count), np.roll(np.arange(3 * size), -size)
        dwx = (embedded @ flows.transpose(0, 2, 1)).sum(axis=0)[:, turn]
        de = (flows.transpose(0, 2, 1) @ np.roll(w["wx"], size, axis=1).T).reshape(steps * count, -1).T.copy()
        rows = np.flatnonzero(np.bincount(source, minlength=len(w["emb"])))
        summed = np.stack([np.bincount(source, d, len(w["emb"]))[rows] for d in de], axis=1).astype(dtype)
        for name, bias, gradient in (("wc", "bc", out_c.T), ("wo", "bo", out_w.T), ("wx", "bx", dwx)):
            self._update(name, gradient[:-1])
            self._update(bias, gradient[-1])
        self._update("wh", dwh)
        self._update("emb", summed, rows)
        return h


# -- distributed training and scoring ------------------------------------------------------------------------------

def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of (tokens, tokens * weights) over a partition, row by row."""
    tokens, total = 0, None
    for batch in batches:
        for n, w in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = np.frombuffer(w.as_py(), np.float64)
            tokens, total = tokens + n, values if total is None else total + values
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["tokens", "weights"])


def _trained(texts: DataFrame, shared, state: list[dict[str, np.ndarray]], start: bool = False) -> list[dict[str, np.ndarray]]:
    """[weights, squared steps] after every task has gone over its texts from ``state``, averaged by tokens."""
    spark = texts.sparkSession
    begin = spark.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.only(None)
        v = shared.value
        reader, trainer = Reader(v), Trainer(v, *begin.value)
        sample = []
        for whole in batches:
            for batch in common.slices(whole, SLICE):
                ids = [own for some in common.slices(batch, READ) for _, own in reader.read_all(some.column(1))]
                if start:  # at most START texts
                    sample += ids
                else:
                    trainer.learn(ids)
        for _ in range(EPOCHS if sample else 0):
            trainer.learn(sample)
        if trainer.tokens:
            flat = np.concatenate([packed(trainer.w), packed(trainer.square)]).astype(np.float64) * trainer.tokens
            yield pa.RecordBatch.from_arrays([pa.array([trainer.tokens], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["tokens", "weights"])

    schema = "tokens long, weights binary"
    row = texts.mapInArrow(run, schema).repartition(AVERAGERS).mapInArrow(_sum, schema).repartition(1).mapInArrow(_sum, schema).first()
    if not row:
        return state
    return [unpacked(part, state[0]) for part in np.split(np.frombuffer(row.weights, np.float64) / row.tokens, 2)]


def train(texts: DataFrame, v: Vocabulary, shared) -> dict[str, np.ndarray]:
    """The trained weights (about 1 MB) from (doc_id, text)."""
    state = [initial(v)]
    # a share of the hashes that START texts are expected in, so that a task sends a few texts to the sort, not START
    order, space = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 31)), 1 << 31
    share = F.lit(int(min(space, space * (START + 4 * START**0.5) / max(1, v.texts))))
    begin = texts.select("doc_id", "text").where(order < share).orderBy(order, "doc_id").limit(START).coalesce(1)
    state = _trained(begin, shared, state, start=True)
    for k in range(ROUNDS):
        state = _trained(texts.where(F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(ROUNDS)) == k), shared, state)
    return state[0]


def score(docs: DataFrame) -> DataFrame:
    """Per text: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    common.ship(spark)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    training = texts.where(~held_out())
    counts = count_tokens(training)
    v = Vocabulary(counts)
    shared = spark.sparkContext.broadcast(v)
    weights = spark.sparkContext.broadcast(train(training, v, shared) if v.n else initial(v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.only(None)
        v = shared.value
        reader, w = Reader(v), weights.value
        end = float(np.log10(v.counts[v.tokens == _signed(END)] + 1.0).sum())
        for whole in batches:
            for batch in common.slices(whole, SLICE):
                ids, tokens, found, base, out, rare, rare_n = [], [], [], [], [], [], []
                for slots, own in (x for some in common.slices(batch, READ) for x in reader.read_all(some.column(1))):
                    logs, other = reader.logs[slots], own[:-1] >= VOCABULARY
                    ids.append(own)
                    tokens.append(len(own))
                    found.append(int((logs > 0).sum()) + (end > 0))
                    base.append(float(logs.sum()) + end)
                    # of words outside the vocabulary: log10(c + 1) of the broadcast ones joins the share here
                    out.append(float(logs[other].sum() - v.share[own[:-1][other] - VOCABULARY].sum()))
                    odd, times = np.unique(reader.hashes[slots[logs == 0]], return_counts=True)
                    if not end:
                        odd, times = np.append(odd, _signed(END)), np.append(times, 1)
                    rare.append(odd)
                    rare_n.append(times.astype(np.int32))
                scores = score_texts(v, w, ids) + np.array(out)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(tokens, pa.int64()), pa.array(found, pa.int64()), pa.array(base, pa.float64()), pa.array(scores, pa.float64()),
                        pa.array(rare, pa.list_(pa.int64())), pa.array(rare_n, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n_tokens", "found", "base", "model", "rare", "rare_n"],
                )

    schema = "doc_id long, n_tokens long, found long, base double, model double, rare array<long>, rare_n array<int>"
    rows = common.written(texts.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("token"), F.col("x.rare_n").alias("times"))
    tail = counts.where(F.col("c") < v.least).select("token", "c")
    more = rare.join(tail, "token").groupBy("row").agg(F.sum("times").cast("long").alias("also"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs"))
    all_rows = rows.drop("rare", "rare_n").join(more, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return all_rows.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", (F.col("found") + F.coalesce("also", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(v.n).cast("long").alias("train_tokens"), (F.col("base") + logs - F.col("n_tokens") * F.lit(v.base)).alias("base_score"), (F.col("model") + logs).alias("score"),
    )
