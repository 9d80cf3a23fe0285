"""Secret scan: fixed-form keys, and values in credential context judged by password guess cost.

A value that follows a credential word is a secret if guessing it would take many tries. The number of tries is
the cheapest way to cut the value into words, dates, repeats, keyboard walks and brute-force spans, found by
dynamic programming over its positions: cost(j) = min over spans (i, j) of cost(i) + log10 guesses(i, j).

Words are ranked: those of ``WORDS`` first, then the words of the corpus itself by the number of documents that hold
them (:func:`ranked_words`, at most ``RANKED``). A run of letters that reads like a word but has no rank costs
``UNRANKED``, so that plain prose ("Your password is incorrect") stays below the limit whatever the corpus.

Spans are (kind, start, end) in code points, end exclusive:

* ``assign``, ``access``, ``hex``: by their form alone (see ``FORMS``);
* ``guess``: a value in credential context, of at least ``MIN_LENGTH`` characters, whose cost reaches
  ``MIN_COST``, unless one ``assign`` span holds all of it.

Credential context is a name with a credential word before ``:``, ``=``, ``:=``, ``=>`` or ``is``; an option (``--password x``); and
the password of a URL (``scheme://user:x@host``). A value in quotes ends at its own quote.

Edge cases: a null or empty text has no spans; a text of any length is scanned whole (spans are found by linear
scans; the dynamic program runs over values cut into pieces of ``PIECE`` characters, whose costs add up); repeated
rows give equal rows.
"""

from __future__ import annotations

import collections
import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

MIN_LENGTH, MIN_COST, PIECE = 8, 10.0, 64
#: Words taken from the corpus, the fewest documents that must hold one, and log10 guesses of a word without a rank.
RANKED, FEWEST, UNRANKED = 20_000, 3, 5.3

# The forms of the base spans, and what a match must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")

#: Credential context: a name, a separator, a value up to white space or a quote. A name is looked at from its start only,
#: so that a long one is read once.
NAMED = re.compile(r"""(?<![A-Za-z0-9_-])([A-Za-z0-9_-]++)["']?(?:\x20*+(:=|=>|[:=]|\bis\b)|(?<=[A-Za-z0-9])(\x20)(?=[^\x20-]))""", re.IGNORECASE | re.ASCII)
#: In quotes: all up to the same quote. Else up to white space, to a closing tag, or to a quote that ends a value.
_VALUE = r"""(?:(["'])((?:(?!\1)\S)++)\1|["']?([^\s"'<>](?:[^\s"'<]|["'](?=[^\s"',;:)\]}])|<(?!/))*+))"""
VALUE = re.compile(r"\x20*(?:bearer\x20+)?" + _VALUE, re.IGNORECASE | re.ASCII)
AUTH_VALUE = re.compile(r"""\x20*["']?(?:(?:bearer|basic|token)\x20+)?""" + _VALUE, re.IGNORECASE | re.ASCII)
URL = re.compile(r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\s/:@"'<>]{0,200}:([^\s/@"'<>]+)@""", re.ASCII)
#: What a reference to a value begins with.
REFERENCES = ("${", "{{", "$(", "%(")
#: The credential word of a name: anything may stand before it (but ``compass`` and the like have no ``pass``), and further
#: parts after it, set off by ``_``, ``-``, a digit or a capital. Before ``is`` the name ends with the word.
_WORD = r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|auth(?:orization)?|(?:api|access|private)[_-]?key|(?<!com)(?<!by)(?<!tres)(?<!sur)(?<!over)(?<!under)pass|bearer)"""
CREDENTIAL = re.compile(_WORD + r"(?:$|[_0-9-]|(?-i:(?<=[a-z])[A-Z]))", re.IGNORECASE | re.ASCII)
CREDENTIAL_END = re.compile(_WORD + "$", re.IGNORECASE | re.ASCII)

#: One of these is in every match of ASSIGN, and in every credential word; plain substring searches spare most texts the patterns.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "cred", "auth", "key", "bearer")
HEX_MASK = bytes(ord("x") if chr(b) in "0123456789abcdef" else ord(".") for b in range(256))
HEX_RUN = b"x" * 16
#: ASCII letters in lower case; every other byte separates words, so words with other letters fall apart (and aren't ranked whole).
_WORD_FOLD = bytes(b if 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

# Frequent password words, months and words that stand after a credential word, and the rows of a keyboard.
WORDS = """password admin login welcome qwerty letmein monkey dragon master sunshine princess football baseball shadow
superman batman trustno hello freedom whatever michael jordan hunter ranger buster soccer hockey killer george
charlie andrew michelle love pepper daniel access mustang summer winter spring autumn secret test guest user root
public private server database default change please example sample token key value none null true false your my
the and for with from this that here there insert replace enter placeholder redacted xxxx todo fixme
january february march april may june july august september october november december
not has been will must can only same by is a an to of in on incorrect invalid required optional missing expired disabled
enabled wrong empty unknown correct important mandatory different automatically wonderful hidden stored encrypted hashed
generated refreshed rejected accepted protected sent reset changed passwords credentials authentication""".split()
ROWS = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz"]


class Ranks(dict):
    """Rank by word, and the first three letters of all words."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__(ranks)
        self.heads = {w[:3] for w in ranks}

    def __reduce__(self):
        return Ranks, (dict(self),)


RANK = Ranks({w: i + 1 for i, w in enumerate(WORDS)})
#: Letters of one case, the first perhaps a capital; with a vowel (or letters beyond ASCII), without long runs of consonants.
LETTERS = re.compile(r"[^\W\d_]+")
UNWORDLY = re.compile("[bcdfghjklmnpqrstvwxz]{5}|[aeiouy]{4}|[jqvxz]{2}|q(?!u)")
LEET = str.maketrans("013457@$!", "oieastasi")
NEIGHBOURS = {(a, b) for row in ROWS for x, y in zip(row, row[1:], strict=False) for a, b in ((x, y), (y, x))}
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
#: log10 guesses of a date: days of 120 years; of a year alone: 120.
DATE_COST, YEAR_COST = math.log10(120 * 365), math.log10(120)


def _alphabet(value: str) -> float:
    """log10 of the symbols a brute-force guess must try for each character of ``value``."""
    size = 26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value) + 10 * any("0" <= c <= "9" for c in value)
    return math.log10(max(10, size + 33 * any(not c.isalnum() for c in value)))


def wordly(run: str) -> bool:
    """Whether a run of letters reads like a word: three letters at least, natural case, vowels where they belong."""
    if len(run) < 3 or not (run.islower() or run.isupper() or (run[0].isupper() and run[1:].islower())):
        return False
    low = run.lower()
    return not low.isascii() or (any(c in "aeiouy" for c in low) and not UNWORDLY.search(low))


def span_costs(value: str, rank: Ranks) -> list[list[tuple[int, float]]]:
    """For each position, (stop, log10 guesses) of the spans that begin there: every way to guess a part in one go."""
    n, low = len(value), value.lower()
    plain, one, heads = low.translate(LEET), _alphabet(value), rank.heads
    # a lower-case hex string is guessed from 16 symbols
    if n >= 16 and all(c in "0123456789abcdef" for c in value):
        one = math.log10(16)
    runs = {m.start(): m.end() for m in LETTERS.finditer(value) if wordly(m[0])}
    out = []
    for at in range(n):
        spans = [(at + 1, one)]  # brute force, one character on
        for text in {low, plain}:
            for stop in range(at + 3, min(n, at + 14) + 1) if text[at : at + 3] in heads else ():
                if r := rank.get(text[at:stop]):
                    shape = 0.0 if value[at:stop] == text[at:stop] else 0.5  # capitals or swapped digits
                    spans.append((stop, math.log10(r + 1) + shape))
        if stop := runs.get(at):
            spans.append((stop, UNRANKED))
        if value[at].isdigit() and (m := DATE.match(value, at)):
            spans.append((m.end(), DATE_COST if m.end() - at > 4 else YEAR_COST))
        stop = at + 1  # a repeated character, each length of the run
        while stop < n and value[stop] == value[at]:
            stop += 1
            spans.append((stop, one + math.log10(stop - at)))
        stop, turns, way = at + 1, 1, None  # a walk along neighbouring keys
        while stop < n and (low[stop - 1], low[stop]) in NEIGHBOURS:
            now = low[stop - 1] < low[stop]
            turns += way is not None and now != way
            way, stop = now, stop + 1
            if stop - at >= 3:
                spans.append((stop, math.log10(47 * (stop - at)) + turns * 0.6))
        for size in range(2, min(8, (n - at) // 2) + 1):  # a repeated block
            stop = at + size
            while value[stop : stop + size] == value[at : at + size] and stop + size <= n:
                stop += size
                spans.append((stop, size * one + math.log10((stop - at) // size)))
        out.append(spans)
    return out


def _piece_cost(value: str, rank: Ranks) -> float:
    best = [0.0] + [math.inf] * len(value)
    for at, spans in enumerate(span_costs(value, rank)):
        for stop, cost in spans:
            best[stop] = min(best[stop], best[at] + cost)
    return best[-1]


def guess_cost(value: str, rank: Ranks = RANK) -> float:
    """log10 of the guesses of the cheapest segmentation; pieces of ``PIECE`` characters add up."""
    pieces = collections.Counter(value[at : at + PIECE] for at in range(0, len(value), PIECE))
    return sum(n * _piece_cost(piece, rank) for piece, n in pieces.items())


def prose(value: str, rank: Ranks = RANK) -> bool:
    """Words joined by hyphens, dots or apostrophes, and nothing else."""
    runs = LETTERS.findall(value)
    return bool(runs) and not LETTERS.sub("", value).strip("-.'_") and all(wordly(r) or r.lower() in rank for r in runs)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the spans by form; leftmost matches that don't qualify are dropped."""
    low, out = text.lower(), []
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if HEX_RUN in text.encode().translate(HEX_MASK):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each value in credential context; a name whose value would lie inside the value before is passed over,
    so the whole scan is linear."""
    until = 0
    for m in NAMED.finditer(text):
        separator = m[2] or ""
        if m.end() < until:
            continue
        if m[3]:  # a blank: only an option's value
            if not (text[m.start() : m.start() + 1] == "-" and CREDENTIAL_END.search(m[1])):
                continue
        elif not (CREDENTIAL if separator.lower() != "is" else CREDENTIAL_END).search(m[1]):
            continue
        if value := (AUTH_VALUE if "auth" in m[1].lower() else VALUE).match(text, m.end()):
            until = value.end()
            yield value.span(2 if value[1] else 3)
    if "://" in text:
        yield from (m.span(1) for m in URL.finditer(text))


def context_values(text: str, rank: Ranks = RANK) -> list[tuple[int, int, float]]:
    """(start, end, cost) of each value in credential context that is long and costly enough, without the punctuation that ends it.

    Plain words joined by hyphens or dots, and references to a value kept elsewhere (``${NAME}``), are no secrets.
    """
    out: dict[int, tuple[int, int, float]] = {}
    for s, e in _candidates(text):
        while e > s and text[e - 1] in ".,;:!?)":
            e -= 1
        if e - s < MIN_LENGTH or s in out:
            continue
        if text.startswith(REFERENCES, s) or prose(text[s:e], rank):
            continue
        if (cost := guess_cost(text[s:e], rank)) >= MIN_COST:
            out[s] = s, e, cost
    return sorted(out.values())


def judged_spans(text: str, rank: Ranks = RANK) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], dict[tuple[int, int], float]]:
    """The base spans, all spans with those of the guess-cost method, and the costs of the latter."""
    base = base_spans(text)
    more, costs = [], {}
    low = text.lower()
    if any(h in low for h in CONTEXT_HINTS) or "://" in low:
        taken = [(s, e) for s, k, e in base if k == 0]
        for s, e, cost in context_values(text, rank):
            if not any(a <= s and e <= b for a, b in taken):
                more.append((s, 3, e))
                costs[s, e] = cost
    return base, sorted(base + more) if more else base, costs


def all_spans(text: str, rank: Ranks = RANK) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    return judged_spans(text, rank)[:2]


def ranked_words(docs: DataFrame, most: int = RANKED, fewest: int = FEWEST) -> Ranks:
    """Rank of each word: ``WORDS``, then the ``most`` words of ASCII letters that at least ``fewest`` documents hold, by their number.

    Counted over all texts; a task sends its counts whenever it holds 200,000 words, so its memory stays bounded.
    """
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: collections.Counter = collections.Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in common.byte_texts(batch.column(0)):
                counts.update({w for w in set(text.translate(_WORD_FOLD).split()) if 3 <= len(w) <= 14})
                if len(counts) >= 200_000:
                    yield sent()
                    counts.clear()
        yield sent()

    counted = docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)
    top = counted.orderBy(F.desc("n"), "word").limit(most).collect()
    rank = dict(RANK)
    for r in top:
        rank.setdefault(r.word, len(rank) + 1)
    return Ranks(rank)


def spelled(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, rank: Ranks | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess, guess_costs`` of every text.

    One narrow pass over (doc_id, text), after one that ranks the words unless ``rank`` is given. ``spans`` and the costs
    (one per guess span, in order) are whole.
    """
    common.ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranked_words(docs) if rank is None else rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in common.slices(whole):
                rows = []
                for text in batch.column(1):
                    text = text.as_py() or ""
                    base, every, costs = judged_spans(text, sent.value)
                    counts = [sum(k == kind for _, k, _ in every) for kind in range(4)]
                    said = spelled(base)
                    costs = [round(costs[s, e], 3) for s, k, e in every if k == 3]
                    rows.append((*counts[:3], hashlib.sha256(said.encode()).hexdigest(), spelled(every), counts[3], costs))
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.list_(pa.float64())]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "guess_costs"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, guess_costs array<double>"
    )


def redacted(text: str, rank: Ranks = RANK) -> str:
    """The text with every secret replaced; of an assignment only the value goes, overlapping spans go as one.

    Exclamation and question marks that end a value by guess cost go with it, as they may be part of it. Plain words after
    a colon and a blank ("token: automatically") stay, though their form is that of an assignment.
    """
    _, spans = all_spans(text, rank)
    if not spans:
        return text
    cuts: list[list[int]] = []
    for s, k, e in spans:
        if k == 0:
            m = ASSIGN.match(text, s)
            if text[: m.start(2)].endswith(": ") and prose(m[2], rank):
                continue
            s = m.start(2)
        cuts.append([s, k, e])
    merged: list[list[int]] = []
    for s, k, e in sorted(cuts):
        while k == 3 and e < len(text) and text[e] in "!?":
            e += 1
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    out, at = [], 0
    for s, e in merged:
        out += [text[at:s], "[SECRET]"]
        at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rank: Ranks | None = None) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` brought up to date; every row and column stays, with its type."""
    common.ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranked_words(docs) if rank is None else rank)
    kinds = dict(docs.dtypes)
    sized = kinds.get("n_chars") in ("int", "bigint", "smallint", "tinyint")
    names = ["text", *(c for c in docs.columns if c != "text")]
    schema = ", ".join(f"`{c}` {'long' if c == 'n_chars' and sized else kinds[c]}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [redacted(x, sent.value) if (x := t.as_py()) else x for t in batch.column(0)]
            cols = [pa.array(texts, pa.string()), *batch.columns[1:]]
            if sized:
                at = names.index("n_chars")
                cols[at] = pa.array([old.as_py() if t is None else len(t) for t, old in zip(texts, batch.column(at), strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names)

    out = docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, schema)
    return out.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in docs.columns])
