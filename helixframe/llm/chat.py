r"""Chat formatting: typed content parts flattened into a turn template with a loss mask.

A message's content is a list of parts (text, image, audio, document). A visitor flattens
them in order: text is escaped, every other part becomes a numbered placeholder, and its
reference and expanded token count are recorded as an attachment. The template is

    <|im_start|>role\nbody<|im_end|>\n

Texts hold no bare ``|`` after escaping (``\`` becomes ``\\``, ``|`` becomes ``\p``, and in a
role a line feed becomes ``\n``), so no text can form a control string, alone or across
parts, and ``unescape`` restores it exactly. The loss mask covers the bodies of assistant
turns.

``format_messages`` gives one segment per row; the formatted conversation is its segments
in order. Nothing is gathered into one value, so a conversation of any length stays a stream
of rows; ``conversation_digest`` reads segments back in order with a constant state.

Null text is an empty text, null role an empty role; a null conversation id is one
conversation of its own, a null turn comes first, equal turns are ordered by role, then text,
repeated rows are turns of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
PATCH = 28
AUDIO_TOKENS_PER_SECOND = 12.5
TOKENS_PER_PAGE = 256

PART_TYPE = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT_TYPE = "array<struct<placeholder:string,ref:string,tokens:long>>"
_SEGMENT = re.compile(r"<\|im_start\|>([^\n|]*)\n(.*)<\|im_end\|>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_PLAIN = {"p": "|", "n": "\n", "\\": "\\"}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("|", "\\p")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text) if "\\" in text else text


@dataclass
class Text:
    text: str

    def accept(self, visitor: Flattener) -> None:
        visitor.text(self)


@dataclass
class Image:
    ref: str
    width: int = 0
    height: int = 0

    def accept(self, visitor: Flattener) -> None:
        tokens = math.ceil(self.width / PATCH) * math.ceil(self.height / PATCH)
        visitor.attachment("image", self.ref, tokens)


@dataclass
class Audio:
    ref: str
    seconds: float = 0.0

    def accept(self, visitor: Flattener) -> None:
        visitor.attachment("audio", self.ref, math.ceil(self.seconds * AUDIO_TOKENS_PER_SECOND))


@dataclass
class Document:
    ref: str
    pages: int = 0

    def accept(self, visitor: Flattener) -> None:
        visitor.attachment("document", self.ref, self.pages * TOKENS_PER_PAGE)


class Flattener:
    """Visitor that writes the body of one message and its attachments."""

    def __init__(self) -> None:
        self.body: list[str] = []
        self.attachments: list[dict] = []

    def text(self, part: Text) -> None:
        self.body.append(escape(part.text))

    def attachment(self, kind: str, ref: str, tokens: int) -> None:
        placeholder = f"<|{kind}_{len(self.attachments) + 1}|>"
        self.body.append(placeholder)
        self.attachments.append({"placeholder": placeholder, "ref": ref, "tokens": tokens})


def part_of(row: dict) -> Text | Image | Audio | Document:
    """A typed part from a row of ``PART_TYPE``; unknown types are kept as text."""
    kind, ref = row.get("type"), row.get("ref") or ""
    if kind == "image":
        return Image(ref, row.get("width") or 0, row.get("height") or 0)
    if kind == "audio":
        return Audio(ref, row.get("seconds") or 0.0)
    if kind == "document":
        return Document(ref, row.get("pages") or 0)
    return Text(row.get("text") or "")


def segment_of(role: str | None, parts: list) -> tuple[str, int, int, list[dict]]:
    """The formatted turn, start and length of its masked part, its attachments."""
    flat = Flattener()
    for part in parts:
        part.accept(flat)
    head, body = f"{START}{escape_role(role or '')}\n", "".join(flat.body)
    masked = len(body) if role == LOSS_ROLE else 0
    return f"{head}{body}{END}\n", len(head), masked, flat.attachments


def read_segment(segment: str) -> tuple[str, str]:
    """Role and body of a formatted turn, unescaped; placeholders stay as they are."""
    role, body = _SEGMENT.fullmatch(segment).groups()
    return unescape(role), unescape(body)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        typed = "parts" in batch.schema.names
        roles = batch.column("role").to_pylist()
        if typed:
            contents = [[part_of(p) for p in parts or []] for parts in batch.column("parts").to_pylist()]
        else:
            contents = [[Text(t or "")] for t in batch.column("text").to_pylist()]
        made = [segment_of(r, c) for r, c in zip(roles, contents)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                pa.array([m[0] for m in made], pa.string()),
                pa.array([m[1] for m in made], pa.int64()),
                pa.array([m[2] for m in made], pa.int64()),
                pa.array(
                    [m[3] for m in made],
                    pa.list_(pa.struct([("placeholder", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])),
                ),
            ],
            names=["conv_id", "turn", "segment", "loss_start", "loss_length", "attachments"],
        )


def format_messages(messages: DataFrame) -> DataFrame:
    """One formatted segment per message of (``conv_id``, ``turn``, ``role``, ``text`` or ``parts``).

    ``parts`` (array of ``PART_TYPE``) takes precedence over ``text``; other columns are ignored.
    """
    content = "parts" if "parts" in messages.columns else "text"
    rows = messages.select(*[F.col(f"`{n}`") for n in ("conv_id", "turn", "role", content)])
    conv, turn = (rows.schema[n].dataType.simpleString() for n in ("conv_id", "turn"))
    return rows.mapInArrow(
        _format,
        f"conv_id {conv}, turn {turn}, segment string, loss_start long, loss_length long, attachments {ATTACHMENT_TYPE}",
    )


class _Reading:
    """What is known of the conversation that is being read."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.turns, self.chars, self.loss = conv_id, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int, length: int) -> None:
        role, body = read_segment(segment)
        self.turns += 1
        self.chars += len(segment)
        self.turn_hash.update(f"{role}\n{body}\n".encode())
        masked = unescape(segment[start : start + length])
        self.loss += len(masked)
        self.loss_hash.update(masked.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars


_DIGEST = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Reading | None = None
    id_type = None
    for batch in batches:
        id_type = batch.schema.field("conv_id").type
        done = []
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "segment", "loss_start", "loss_length"))
        for conv_id, segment, start, length in zip(*columns):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Reading(conv_id)
            current.add(segment, start, length)
        if done:
            yield _rows(done, id_type)
    if current is not None:
        yield _rows([current.row()], id_type)


def _rows(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=list(_DIGEST))


def _unescaped(text: Column) -> Column:
    """``unescape`` as a column: between escaped backslashes no escape can begin elsewhere."""
    pieces = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(pieces, lambda x: F.replace(F.replace(x, F.lit(r"\p"), F.lit("|")), F.lit(r"\n"), F.lit("\n"))), "\\")


def conversation_digest(segments: DataFrame) -> DataFrame:
    """Turns, hashes and lengths per conversation, read back from formatted segments.

    A hash over turns in order is sequential within a conversation, so a conversation is
    read by one task, but as a sorted stream: no group is held in memory. Equal turns are put
    in order by what the segment says, not by its escapes or its end mark.
    """
    segment, head = F.col("segment"), F.col("loss_start").cast("int")
    role = F.substr(segment, F.lit(len(START) + 1), head - F.lit(len(START) + 1))
    body = F.substr(segment, head + 1, F.length(segment) - head - F.lit(len(END) + 1))
    keyed = segments.repartition("conv_id").withColumns({"role_key": _unescaped(role), "body_key": _unescaped(body)})
    ordered = keyed.sortWithinPartitions("conv_id", "turn", "role_key", "body_key")
    conv = segments.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", "segment", "loss_start", "loss_length").mapInArrow(
        _read,
        f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
