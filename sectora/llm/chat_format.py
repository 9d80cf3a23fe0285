"""Chat formatting: conversations of typed content parts, flattened to one marked text for each turn.

A turn's content is a list of parts: text, image, audio or document. A visitor (:class:`Flatten`) walks them in order:
texts are escaped, every other part leaves one placeholder (``<|image|>``), a reference to its attachment, and the
number of tokens that the placeholder stands for (patches of an image, frames of a sound, pages of a document).

Template of a turn: ``<|im_start|>role\\n`` content ``<|im_end|>\\n``. Control strings begin with ``<|``. Inside texts and roles,
``<``, any number of backslashes and ``|`` get one more backslash, so no text holds ``<|``; taking one away restores it.
Neighbouring text parts are joined before they are escaped, so no control string arises between them. In a role,
backslashes and line feeds are escaped first.

A conversation is as many output rows as it has turns, since one alone may hold a third of all rows: its formatted text is that of its
rows by ``turn`` (ties by the formatted text). The loss mask is a span of code points in each assistant row.

:func:`read_back` sorts the rows of a partition by conversation and turn, parses each, and digests a conversation as a stream, so
that memory stays bounded by one turn. A digest of all text of a conversation has to see it in order, so a
conversation passes through one task; formatting and escaping are done before that exchange, row by row.

Edge cases: a null text, part list or part is the empty text; a null role the empty role; a null conversation id is a
conversation of its own; null turns come first. A part of another kind becomes ``<|file|>`` of one token. Sizes that are
null or below 1 count as 1. Repeated rows are turns of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectora.llm import common

START, END = "<|im_start|>", "<|im_end|>"
PART = "struct<type: string, text: string, ref: string, width: long, height: long, millis: long, pages: long>"
#: One token for each square of PATCH pixels, each FRAME milliseconds, and PAGE tokens for each page.
PATCH, FRAME, PAGE = 28, 40, 256

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_ROLE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|([a-z]+)\|>")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _size(value: int | None) -> int:
    return max(1, value or 1)


class Flatten:
    """Visits the parts of one turn in order; ``visit_<type>`` handles a type."""

    def __init__(self, role: str):
        self.pieces = [START, escape_role(role), "\n"]
        self.at = self.begin = sum(map(len, self.pieces))
        self.plain: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict | None) -> None:
        part = part or {"type": "text"}
        getattr(self, f"visit_{part.get('type')}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.plain.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, -(-_size(part["width"]) // PATCH) * -(-_size(part["height"]) // PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, -(-_size(part["millis"]) // FRAME))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, _size(part["pages"]) * PAGE)

    def visit_other(self, part: dict) -> None:
        self._attach("file", part, 1)

    def _put(self, piece: str) -> None:
        self.pieces.append(piece)
        self.at += len(piece)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self._flush()
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "at": self.at, "tokens": tokens})
        self._put(f"<|{kind}|>")

    def _flush(self) -> None:
        if self.plain:
            self._put(escape("".join(self.plain)))
            self.plain = []

    def done(self) -> tuple[str, int, int, list[dict]]:
        """The formatted turn, the span of its content in code points, and its attachments."""
        self._flush()
        stop = self.at
        self._put(f"{END}\n")
        return "".join(self.pieces), self.begin, stop, self.attachments


def flatten(role: str | None, parts: list[dict | None] | None) -> tuple[str, int, int, list[dict]]:
    visitor = Flatten(role or "")
    for part in parts or []:
        visitor.visit(part)
    return visitor.done()


def parse(formatted: str) -> tuple[str, list[tuple[str, str]]]:
    """The role of a formatted turn and its parts: ('text', text) or (kind, '') of each placeholder, in order."""
    turn = _TURN.fullmatch(formatted)
    if not turn or START in turn[2] or END in turn[2]:
        raise ValueError("not one formatted turn")
    parts, at = [], 0
    for m in _PLACEHOLDER.finditer(turn[2]):
        parts += [("text", unescape(turn[2][at : m.start()]))] * (m.start() > at) + [(m[1], "")]
        at = m.end()
    return unescape_role(turn[1]), parts + [("text", unescape(turn[2][at:]))] * (at < len(turn[2]))


FORMATTED = "conv_id long, turn long, formatted string, loss_start long, loss_end long, attachments array<struct<kind: string, ref: string, at: long, tokens: long>>"
_ATTACHED = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))


def format_turns(messages: DataFrame) -> DataFrame:
    """``FORMATTED`` of messages ``conv_id, turn, role, parts`` (an array of ``PART``), row by row.

    ``loss_start`` and ``loss_end`` hold the content of assistant turns and are null elsewhere.
    """
    common.ship(messages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for role, parts in zip(batch.column(2), batch.column(3), strict=True):
                role = role.as_py()
                text, start, stop, attached = flatten(role, parts.as_py())
                rows.append((text, start, stop, attached) if role == "assistant" else (text, None, None, attached))
            types = [pa.string(), pa.int64(), pa.int64(), _ATTACHED]
            columns = zip(*rows, strict=True) if rows else ([] for _ in types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["conv_id", "turn", "formatted", "loss_start", "loss_end", "attachments"])

    return messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.col("parts").cast(f"array<{PART}>")).mapInArrow(run, FORMATTED)


def text_parts(text):
    """A plain text column as a list of one text part."""
    missing = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "long"), ("height", "long"), ("millis", "long"), ("pages", "long"))]
    return F.array(F.struct(F.lit("text").alias("type"), F.col(text).alias("text"), *missing))


class _Conversation:
    """Running digests of one conversation."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = self.attachments = self.attached_tokens = 0

    def add(self, formatted: str, start: int | None, stop: int | None, attached: list[dict]) -> None:
        role, parts = parse(formatted)
        kinds = [kind for kind, _ in parts if kind != "text"]
        if kinds != [a["kind"] for a in attached]:
            raise ValueError("placeholders and attachments differ")
        self.turns.update(f"{role}\n{''.join(text for _, text in parts)}\n".encode())
        self.n_turns += 1
        self.formatted_chars += len(formatted)
        self.attachments += len(attached)
        self.attached_tokens += sum(a["tokens"] for a in attached)
        if start is not None:
            text = unescape(_PLACEHOLDER.sub("", formatted[start:stop]))
            self.loss.update(text.encode())
            self.loss_chars += len(text)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.attachments, self.attached_tokens


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its formatted turns hold: the turns, the text under the loss mask, the attachments."""
    common.ship(formatted.sparkSession)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "attached_tokens"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conversation, rows = None, None, []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for conv, *turn in zip(*batch.columns, strict=True):
                conv = conv.as_py()
                if conversation is None or conv != now:
                    if conversation is not None:
                        rows.append((now, *conversation.row()))
                    now, conversation = conv, _Conversation()
                conversation.add(*(x.as_py() for x in turn))
            if len(rows) >= 10_000:
                yield batch_of(rows)
                rows = []
        if conversation is not None:
            yield batch_of([*rows, (now, *conversation.row())])

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    schema = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types, strict=True))
    return rows.select("conv_id", "formatted", "loss_start", "loss_end", "attachments").mapInArrow(run, schema)
