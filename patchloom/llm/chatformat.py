"""Chat formatting from typed content parts, with masks, attachments and a way back."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import prepared

# A turn is <|turn|>role<|text|>content<|end|>. A control string inside a role or a text gets
# a backslash before its bar, and so does a control string that has some already, so taking
# one backslash away restores the text.
OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
_CONTROL = re.compile(r"<(\\*)\|(turn|text|end|image|audio|document)")
_ESCAPED = re.compile(r"<\\(\\*)\|(turn|text|end|image|audio|document)")
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2", text)


@dataclass
class Flattened:
    """Content as one escaped string, with what was attached and the tokens it stands for.

    Text parts that follow one another are escaped as one text: a control string may be spread
    over several of them.
    """

    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    media_tokens: int = 0
    said: list[str] = field(default_factory=list)  # text since the last placeholder

    def end_text(self) -> None:
        if self.said:
            self.pieces.append(escape("".join(self.said)))
            self.said.clear()


class Visitor:
    """Walks typed parts in order; one method per type.

    An image stands for one token per patch, audio for one per frame, a document for one
    per page times a page's tokens. Sizes that are absent count as one unit.
    """

    def __init__(self, patch: int = 14, frame_ms: int = 40, page_tokens: int = 256):
        self.patch, self.frame_ms, self.page_tokens = patch, frame_ms, page_tokens

    def flatten(self, content: str | list | dict | None) -> Flattened:
        out = Flattened()
        self.visit(content, out)
        out.end_text()
        return out

    def visit(self, part: object, out: Flattened) -> None:
        if part is None:
            return
        if isinstance(part, str):
            out.said.append(part)
        elif isinstance(part, list):
            for one in part:
                self.visit(one, out)
        elif isinstance(part, dict):
            handler = getattr(self, f"visit_{part.get('type', 'text')}", None)
            if handler is None:
                raise ValueError(f"unknown content type {part.get('type')!r}")
            handler(part, out)
        else:
            raise ValueError(f"content part of type {type(part).__name__}")

    def visit_text(self, part: dict, out: Flattened) -> None:
        self.visit(part.get("text") or part.get("parts"), out)

    def visit_image(self, part: dict, out: Flattened) -> None:
        wide, high = (-(-max(int(part.get(k) or 1), 1) // self.patch) for k in ("width", "height"))
        self._attach("image", part, wide * high, out)

    def visit_audio(self, part: dict, out: Flattened) -> None:
        self._attach("audio", part, -(-max(int(part.get("ms") or 1), 1) // self.frame_ms), out)

    def visit_document(self, part: dict, out: Flattened) -> None:
        self._attach("document", part, max(int(part.get("pages") or 1), 1) * self.page_tokens, out)

    def _attach(self, kind: str, part: dict, tokens: int, out: Flattened) -> None:
        out.end_text()
        out.pieces.append(f"<|{kind}:{len(out.attachments)}|>")
        out.attachments.append({"kind": kind, "ref": part.get("ref"), "tokens": tokens})
        out.media_tokens += tokens


def format_turns(turns: DataFrame, *, parts: str | None = None) -> DataFrame:
    """Rows conv_id, turn, role, text to formatted segments, one per turn.

    Adds ``formatted``, ``loss_from`` and ``loss_to`` (code points in it that carry loss, equal
    for turns that carry none), ``attachments`` (kind, ref, tokens, in placeholder order) and
    ``media_tokens``. ``parts`` names a column with content as JSON (a string, a part or a list
    of parts, nested at will); without it, or where it is null, the text is the only part. A
    turn is formatted by itself, so a conversation of any length is a sequence of rows.

    Null text or role: empty. Unknown part types and broken JSON raise an error. Other columns
    are dropped.
    """
    prepared(turns.sparkSession)
    visitor = Visitor()
    source = turns.select("conv_id", "turn", "role", "text", (F.col(parts) if parts else F.lit(None).cast("string")).alias("_parts"))
    attachment = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, low, high, attached, media = [], [], [], [], []
            for role, text, content in zip(*(batch.column(c).to_pylist() for c in ("role", "text", "_parts"))):
                flat = visitor.flatten(json.loads(content) if content is not None else text)
                head, body = f"{OPEN}{escape(role or '')}{BODY}", "".join(flat.pieces)
                whole.append(head + body + CLOSE)
                low.append(len(head))
                high.append(len(head) + (len(body) if role == "assistant" else 0))
                attached.append(flat.attachments)
                media.append(flat.media_tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(whole, pa.string()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(attached, pa.list_(attachment)), pa.array(media, pa.int64())],
                ["conv_id", "turn", "formatted", "loss_from", "loss_to", "attachments", "media_tokens"],
            )

    conv, turn = (turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    return source.mapInArrow(
        run,
        f"conv_id {conv}, turn {turn}, formatted string, loss_from long, loss_to long, "
        "attachments array<struct<kind:string,ref:string,tokens:bigint>>, media_tokens long",
    )


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), unescape(found[2])


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its formatted turns.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars. Turns of a
    conversation are brought together sorted by turn (then by their text, so that repeated
    turn numbers have one order) and digested as they stream by: a task holds a batch and two
    running hashes, however long one conversation is. Rows without conv_id form one
    conversation, and a null turn number comes first.
    """
    placed = formatted.select("conv_id", "turn", "formatted", "loss_from", "loss_to")
    placed = placed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def close() -> tuple:
            return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            done = []
            for this, text, low, high in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_from", "loss_to"))):
                if state is None or this != conv:
                    if state is not None:
                        done.append(close())
                    conv, state = this, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = read_turn(text)
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                loss = unescape(text[low:high])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(text)
            yield _rows(done, names, batch.schema.field("conv_id").type)
        if state is not None:
            yield _rows([close()], names, batch.schema.field("conv_id").type)

    return placed.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _rows(rows: list[tuple], names: list[str], key: pa.DataType) -> pa.RecordBatch:
    types = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
