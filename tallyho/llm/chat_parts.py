"""Chat formatting of typed content parts.

A turn's content is an ordered list of parts: text, image, audio or document.
A visitor flattens them: a text part becomes its escaped text, any other part
a placeholder, with a record of the attachment (its place among the turn's
attachments, reference, kind) and of the tokens that the placeholder expands
to later.  A turn is written as

    <|im_start|>role\\n content <|im_end|>\\n

Control strings (``<|``) inside texts and roles are escaped with a backslash
after the ``<``, one more than there was, so every text reads back as it was
and no text can open, close or fake a turn or a placeholder.

Turns are formatted row by row and stay rows, in order: a conversation of any
length is never one value.  ``read_back`` streams the sorted rows of each
partition and holds one turn at a time.

Defined cases: NULL text, role or part list is empty; a NULL kind is text;
turns are ordered by turn (NULL first), then role, then content; repeated
rows are formatted as often as they occur; rows with a NULL conv_id are one
conversation; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
START, END = "<|im_start|>", "<|im_end|>"
#: Fixed values of the token counts: image patches of 14 pixels merged 2 by 2, 25 audio frames a second, 1200 tokens a page.
PATCH, FRAMES, PAGE = 28, 25, 1200
FORMATTED = "conv_id long, turn long, role string, formatted string, loss_start int, loss_end int, attachments array<struct<place: int, kind: string, ref: string, tokens: int>>"
_ATTACHMENTS = pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())]))
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.DOTALL)


@dataclass
class Flattener:
    """Visits the parts of one turn in order."""

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        # The escape must see the text as a whole: parts in a row may join to a control string.
        self.pieces.append(part.get("text") or "")

    def visit_image(self, part: dict) -> None:
        wide, high = (max(1, math.ceil((part.get(k) or 0) / PATCH)) for k in ("width", "height"))
        self._attach("image", part, wide * high)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * FRAMES)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 0) * PAGE)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part, 1)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.pieces.append(None)
        self.attachments.append({"place": len(self.attachments), "kind": kind, "ref": part.get("ref"), "tokens": tokens})

    def content(self) -> str:
        out, run, place = [], [], 0
        for piece in [*self.pieces, None]:
            if piece is not None:
                run.append(piece)
                continue
            out.append(escape("".join(run)))
            run = []
            if place < len(self.attachments):
                out.append(f"<|{self.attachments[place]['kind']}:{place}|>")
                place += 1
        return "".join(out)


def format_turn(role: str | None, parts: list[dict] | None) -> tuple[str, int, int, list[dict]]:
    """(formatted turn, start and end of the loss mask in it, attachments); the mask is empty but for assistants."""
    visitor = Flattener()
    for part in parts or []:
        visitor.visit(part or {})
    content = visitor.content()
    head = f"{START}{escape_role(role or '')}\n"
    begin, end = (len(head), len(head) + len(content)) if role == "assistant" else (0, 0)
    return f"{head}{content}{END}\n", begin, end, visitor.attachments


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, content as written)."""
    m = _TURN.fullmatch(formatted)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape_role(m[1]), m[2]


def text_of(content: str) -> str:
    """The text parts of a turn's content."""
    return "".join(map(unescape, re.split(r"<\|(?:image|audio|document|other):\d+\|>", content)))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        conv, turn, role, parts = (batch.column(i).to_pylist() for i in range(4))
        done = [format_turn(r, p) for r, p in zip(role, parts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), pa.array(turn, pa.int64()), pa.array(role, pa.string()), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()), pa.array([d[2] for d in done], pa.int32()), pa.array([d[3] for d in done], _ATTACHMENTS)],
            names=["conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "attachments"],
        )


def formatted(turns: DataFrame) -> DataFrame:
    """One row a turn of ``turns`` (conv_id, turn, role, parts: array of PART)."""
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("parts").cast(f"array<{PART}>")).mapInArrow(_format, FORMATTED)


def text_parts(turns: DataFrame) -> DataFrame:
    """Turns whose content is one text column, as typed parts."""
    none = {k: F.lit(None).alias(k) for k in ("ref", "width", "height", "seconds", "pages")}
    return turns.select("conv_id", "turn", "role", F.array(F.struct(F.lit("text").alias("kind"), F.col("text").alias("text"), *none.values())).cast(f"array<{PART}>").alias("parts"))


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, begin: int, end: int) -> None:
        role, content = parse_turn(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.all.update(f"{role}\n{text_of(content)}\n".encode())
        learnt = text_of(formatted[begin:end])
        self.loss_chars += len(learnt)
        self.loss.update(learnt.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now: _Digest | None = None
    for batch in batches:
        done = []
        for conv, text, begin, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv)
            now.add(text, begin, end)
        columns = list(zip(*done, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(now.row(), types, strict=True)], names=names)


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of each conversation, read from formatted turns."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_read, schema)
