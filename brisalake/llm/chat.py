"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document. A visitor
flattens the parts in order: text is escaped, any other part becomes a placeholder
and is recorded as an attachment with its reference and the tokens it expands to.
The template marks turns with control strings, all of which begin with ``<`` or
``[``; in texts these two and the backslash get a backslash before them, so no text
can hold a control string and reading back undoes it.

Every turn is formatted where it is read. Only what must be sequential, a
conversation's digests, sees a whole conversation: sorted turns stream through, and
no conversation is ever held.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the template puts before and after a turn's content, by role; other roles are spelled out.
TEMPLATE = {"system": ("<<SYS>>", "<</SYS>>\n"), "user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", "</s>\n")}
OTHER = ("<<ROLE>>", "<<SAYS>>", "<</ROLE>>\n")
PLACEHOLDERS = {"image": "[IMAGE]", "audio": "[AUDIO]", "document": "[DOCUMENT]"}
# Tokens that one unit of a part expands to: an image's tile, a second of audio, a document's page.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}

PART = "struct<kind: string, text: string, ref: string, units: bigint>"
SEGMENT = ("conv_id bigint, turn bigint, segment string, loss_start bigint, loss_length bigint, "
           "attachments array<struct<kind: string, ref: string, place: bigint, tokens: bigint>>")
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
          "formatted_chars bigint")
SPECIAL, ESCAPED = re.compile(r"([\\<\[])"), re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return SPECIAL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of one turn in order."""

    def __init__(self, start: int):
        self.pieces, self.length, self.attachments = [], start, []

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        if kind == "text":
            self.text(part)
        elif kind in PLACEHOLDERS:
            self.attach(part)
        else:
            raise ValueError(f"unknown kind of part: {kind!r}")

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def text(self, part: dict) -> None:
        self.add(escape(part.get("text") or ""))

    def attach(self, part: dict) -> None:
        kind, units = part["kind"], part.get("units")
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "place": self.length,
                                 "tokens": UNIT_TOKENS[kind] * (1 if units is None else max(units, 0))})
        self.add(PLACEHOLDERS[kind])


def around(role: str) -> tuple[str, str]:
    return TEMPLATE.get(role) or (OTHER[0] + escape(role) + OTHER[1], OTHER[2])


def format_turn(role: str, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """(segment, first code point under the loss mask, its length, attachments)."""
    before, after = around(role)
    flat = Flattener(len(before))
    for part in parts:
        flat.visit(part)
    return (before + "".join(flat.pieces) + after, len(before),
            flat.length - len(before) if role == "assistant" else 0, flat.attachments)


def read_turn(segment: str) -> tuple[str, str]:
    """(role, content as it stands in the segment, still escaped)."""
    if segment.startswith(OTHER[0]):
        role, _, content = segment[len(OTHER[0]):].partition(OTHER[1])
        return unescape(role), content[:-len(OTHER[2])]
    for role, (before, after) in TEMPLATE.items():
        if segment.startswith(before):
            return role, segment[len(before):len(segment) - len(after)]
    raise ValueError("no turn")


def read_parts(content: str, attachments: list[dict]) -> list[dict]:
    """The typed parts of a turn's content; text between placeholders is one part."""
    kinds = {v: k for k, v in PLACEHOLDERS.items()}
    rest, parts = iter(attachments), []
    # An escaped character, a placeholder, or any other character.
    for piece in re.findall(r"\\.|" + "|".join(map(re.escape, kinds)) + "|.", content, re.S):
        if piece in kinds:
            parts.append({"kind": kinds[piece], "ref": next(rest)["ref"]})
        elif parts and parts[-1]["kind"] == "text":
            parts[-1]["text"] += unescape(piece)
        else:
            parts.append({"kind": "text", "text": unescape(piece)})
    return parts


def format_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", parts: str | None = None) -> DataFrame:
    """A row per turn: conv_id, turn, segment, loss_start, loss_length, attachments.

    ``parts`` names a column of type array<struct<kind, text, ref, units>>; without
    it, or where it is null, the text is the turn's one part. Null text is empty, a
    null role is the role without a name; null conversations and turns stay null;
    repeated rows are turns of their own; an unknown kind of part is an error; an
    empty table gives no rows; other columns are not read. Loss covers an
    assistant's content and nothing of the template; counts are code points.
    """
    content: Column = F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                                       F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))
    if parts:
        content = F.coalesce(F.col(parts).cast(f"array<{PART}>"), content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn", "segment", "loss_start", "loss_length", "attachments"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct(
            [("kind", pa.string()), ("ref", pa.string()), ("place", pa.int64()), ("tokens", pa.int64())]))]
        for batch in batches:
            made = [format_turn(r, [x or {} for x in p]) for r, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            columns = [batch.column(0), batch.column(1), *(pa.array([m[i] for m in made], kinds[i + 2]) for i in range(4))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return turns.select(F.col(conversation).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), content.alias("content")).mapInArrow(run, SEGMENT)


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Read back every conversation from its segments, in turn order (ties by segment): one row of DIGEST each.

    A conversation's digests are sequential, so its turns pass through one task, in
    sorted batches; the task keeps two running hashes, not the turns.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, open_, done = None, False, []

        def close() -> None:
            done.append((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        n = chars = loss_chars = 0
        turns = loss = None
        for batch in batches:
            for conv, segment, start, length in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if not open_ or conv != now:
                    if open_:
                        close()
                    now, open_, n, chars, loss_chars, turns, loss = conv, True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                role, content = read_turn(segment)
                turns.update(f"{role}\n{unescape(content)}\n".encode())
                learned = unescape(segment[start:start + length])
                loss.update(learned.encode())
                n, chars, loss_chars = n + 1, chars + len(segment), loss_chars + len(learned)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                done.clear()
        if open_:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    order = ["conv_id", "turn", "segment"]
    return segments.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, DIGEST)
