"""Chat formatting with typed content parts.

A conversation is a list of turns, a turn a role and a list of parts: text, image, audio or document. A
visitor flattens the parts in order. Text is copied with its control strings escaped, adjacent text parts as
one text with one loss span; any other part
becomes a placeholder, which records the attachment it stands for and how many tokens it expands to:

* image: one token a patch of 14 x 14 pixels (`units` is width, `more` is height),
* audio: 25 tokens a second (`units` is milliseconds),
* document: 800 tokens a page (`units` is pages),
* any other kind: nothing is known of it, so it is an attachment `other` of 0 tokens.

Kinds are read without regard to case and white space around them; a part without a kind is text. Units that are
missing or negative count as 0.

A formatted turn is

    <|im_start|>role\\ntext<|im_end|>\\n

and a conversation is its turns in order. Inside texts and roles a backslash is put between `<` and `|`
(after any that are there), so no control string can occur in them, and taken out again on reading. In
roles line feeds, percent signs and `<` are written as `%XX`. The loss mask covers the text parts of assistant
turns and nothing else.

Turns are formatted where they are read. Then turns are placed and sorted by conversation, and `read_back`
parses the formatted text as a stream of characters and folds it into digests: a conversation of any length
passes through a task in pieces and is never held whole. (SHA-256 of a conversation is sequential by
definition, so one conversation stays in one task.)

Defined results: NULL texts and roles are empty; a NULL part list has no parts. Turns are ordered by turn
number (NULL first), then role and formatted text; repeated turns stay. NULL is a conversation id of its own. Very long
texts pass whole through the task that formats them, in pieces through reading. An empty table gives an empty result.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
PATCH = 14
AUDIO_TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 800
PARTS = "array<struct<kind:string,text:string,uri:string,units:long,more:long>>"
_HIDDEN = re.compile(r"<(\\*)\|")
_SHOWN = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _HIDDEN.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _SHOWN.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return role.replace("%", "%25").replace("<", "%3C").replace("\n", "%0A")


KINDS = ("text", "image", "audio", "document")


def kind_of(part: dict) -> str:
    kind = (part["kind"] or "text").strip().lower() or "text"
    return kind if kind in KINDS else "other"


def _units(part: dict, side: str) -> int:
    """At most 2^31, so that what it expands to stays a long."""
    return min(max(part[side] or 0, 0), 1 << 31)


@dataclass
class PartVisitor:
    """Flattens the parts of one turn; attachments are numbered within the turn."""

    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    length: int = 0

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def _attach(self, kind: str, uri: str | None, tokens: int) -> None:
        number = len(self.attachments)
        self.attachments.append({"kind": kind, "number": number, "uri": uri, "position": self.length, "tokens": tokens})
        self._write(f"<|{kind}:{number}:{tokens}|>")

    def visit_text(self, part: dict, masked_in: bool) -> None:
        text = escape(part["text"] or "")
        if masked_in and text:
            self.loss.append({"start": self.length, "end": self.length + len(text)})
        self._write(text)

    def visit_image(self, part: dict, masked_in: bool) -> None:
        across, down = (math.ceil(_units(part, side) / PATCH) for side in ("units", "more"))
        self._attach("image", part["uri"], across * down)

    def visit_audio(self, part: dict, masked_in: bool) -> None:
        self._attach("audio", part["uri"], math.ceil(_units(part, "units") * AUDIO_TOKENS_PER_SECOND / 1000))

    def visit_document(self, part: dict, masked_in: bool) -> None:
        self._attach("document", part["uri"], _units(part, "units") * TOKENS_PER_PAGE)

    def visit_other(self, part: dict, masked_in: bool) -> None:
        self._attach("other", part["uri"], 0)

    def turn(self, role: str, parts: list[dict]) -> None:
        self._write(f"{START}{escape_role(role)}\n")
        for kind, run in groupby(parts, kind_of):
            visit = getattr(self, f"visit_{kind}")
            if kind == "text":  # adjacent texts are read as one, so they are escaped as one
                run = [{"kind": kind, "text": "".join(part["text"] or "" for part in run)}]
            for part in run:
                visit(part, role == ASSISTANT)
        self._write(f"{END}\n")


ATTACHMENTS = "array<struct<kind:string,number:int,uri:string,position:int,tokens:long>>"
LOSS = "array<struct<start:int,end:int>>"


def text_part(text: Column) -> Column:
    """A part list with one text part."""
    empty = F.lit(None).cast("string")
    units = F.lit(None).cast("long")
    part = F.struct(
        F.lit("text").alias("kind"), text.alias("text"), empty.alias("uri"), units.alias("units"), units.alias("more")
    )
    return F.array(part)


def format_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row per turn of (id, turn, role, parts): id, turn, role, formatted text, its attachments (with
    position and expanded tokens) and its loss spans. Positions count characters of the turn."""
    out = T.StructType(
        [
            T.StructField("id", turns.schema[id_col].dataType),
            T.StructField("turn", turns.schema[turn_col].dataType),
            T.StructField("role", T.StringType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("attachments", T.DataType.fromDDL(ATTACHMENTS)),
            T.StructField("loss", T.DataType.fromDDL(LOSS)),
        ]
    )
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, formatted, attachments, loss = [], [], [], []
            for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                visitor = PartVisitor()
                visitor.turn(role or "", [part for part in parts or [] if part])
                roles.append(role or "")
                formatted.append("".join(visitor.out))
                attachments.append(visitor.attachments)
                loss.append(visitor.loss)
            values = [roles, formatted, attachments, loss]
            arrays = [pa.array(v, f.type) for v, f in zip(values, list(arrow)[2:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], arrow.names)

    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), "role", F.col("parts").cast(PARTS).alias("parts")
    )
    return rows.mapInArrow(run, out)


class StreamReader:
    """Parses formatted text that arrives in any pieces; gives (role, text) of every complete turn."""

    def __init__(self) -> None:
        self.rest = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        text, at = self.rest + piece, 0
        while (begin := text.find(START, at)) >= 0:
            line = text.find("\n", begin)
            end = text.find(END + "\n", line) if line >= 0 else -1
            if end < 0:
                break
            yield unquote(text[begin + len(START) : line]), unescape(text[line + 1 : end])
            at = end + len(END) + 1
        self.rest = text[at:]


@dataclass
class _Digest:
    """What is read back from one conversation, so far."""

    reader: StreamReader = field(default_factory=StreamReader)
    turns: int = 0
    whole: object = field(default_factory=hashlib.sha256)
    loss_chars: int = 0
    loss: object = field(default_factory=hashlib.sha256)
    chars: int = 0

    def feed(self, formatted: str, spans: list[dict]) -> None:
        self.chars += len(formatted)
        for role, text in self.reader.feed(formatted):
            self.turns += 1
            self.whole.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for span in spans:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.turns, self.whole.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read from the formatted text: id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [T.LongType(), T.StringType(), T.LongType(), T.StringType(), T.LongType()]
    out = T.StructType([formatted.schema["id"], *[T.StructField(n, t) for n, t in zip(names, types)]])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, done = None, None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(arrow)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], arrow.names)
            done.clear()
            return batch

        for batch in batches:
            for id_, text, spans in zip(*(column.to_pylist() for column in batch.columns)):
                if digest is None or id_ != current:
                    if digest is not None:
                        done.append((current, *digest.row()))
                    current, digest = id_, _Digest()
                digest.feed(text, spans)
            yield flush()
        if digest is not None:
            done.append((current, *digest.row()))
            yield flush()

    ordered = formatted.repartition("id").sortWithinPartitions("id", "turn", "role", "formatted")
    return ordered.select("id", "formatted", "loss").mapInArrow(run, out).withColumnRenamed("id", id_col)
