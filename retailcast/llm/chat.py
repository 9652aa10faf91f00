"""Chat formatting: a finite-state machine over roles emits text segments with loss flags.

A template names, for each role, the marks before and after a text and whether the text counts
for the loss.  Strings that mark turns are escaped inside texts by a backslash after their first
character, and a backslash by another one, so texts can be read back and never close a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm.common import batch_of


@dataclass(frozen=True)
class Template:
    """``turns``: role -> (mark before, mark after, text counts for the loss).  ``moves``: state -> roles
    that may follow; a state is the role before, "" at the start.  ``ends``: states a conversation may end in.
    Roles without an entry use ``other`` with the role's name in place of {role}.  ``controls``: every
    string that marks something, none the beginning of another."""

    turns: dict[str, tuple[str, str, bool]] = field(default_factory=lambda: {
        "system": ("<s><<SYS>>", "<</SYS>>", False), "user": ("<s>[INST]", "[/INST]", False), "assistant": ("<s>", "</s>", True)})
    other: tuple[str, str] = ("<s>[ROLE {role}]", "[/ROLE]")
    controls: tuple[str, ...] = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ROLE ", "[/ROLE]")
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    ends: tuple[str, ...] = ("user", "assistant")

    def escape(self, text: str) -> str:
        starts = "|".join(re.escape(c) for c in self.controls)
        return re.sub(rf"(?=(?:{starts}))(.)", r"\1\\", text.replace("\\", "\\\\"), flags=re.S)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)


SEGMENT = "conv_id long, turn_no long, part int, text string, loss boolean, role string, valid boolean"


def _segments(template: Template):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, n, valid, begun = None, "", 0, True, False
        for batch in batches:
            out = []
            for key, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if not begun or key != conv:
                    conv, state, n, valid, begun = key, "", 0, True, True
                role = role or ""
                valid = valid and role in template.moves.get(state, ())
                if role in template.turns:
                    before, after, loss = template.turns[role]
                else:
                    before, after, loss = template.other[0].format(role=template.escape(role)), template.other[1], False
                for part, (segment, counts) in enumerate(((before, False), (template.escape(text or ""), loss), (after, False))):
                    out.append((key, n, part, segment, counts, role, valid))
                state, n = role, n + 1
            yield batch_of(SEGMENT, out)
    return emit


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments (SEGMENT columns) of all conversations of ``conv_id, turn, role, text``.

    A conversation's turns are taken by turn, then role, then text (null turns first); rows that
    repeat are turns of their own.  Each turn gives three segments: mark, escaped text, mark.  ``valid``
    turns false at the first turn that the machine doesn't allow and stays so; such conversations are
    formatted all the same.  Null text counts as empty, null role as a role without a name, null
    conv_id as a conversation of its own.  No rows: no segments.  Other columns are left out.

    Rows stream through sorted tasks with the machine's state kept from row to row, so a conversation
    of any length needs no memory beyond a batch.
    """
    rows = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_segments(template), SEGMENT))


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "valid boolean")


def _digest(template: Template):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, valid, state = None, False, True, ""
        n = chars = loss_chars = 0
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def row() -> tuple:
            return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid and state in template.ends

        for batch in batches:
            out = []
            names = ("conv_id", "part", "text", "loss", "role", "valid")
            for key, part, text, counts, role, ok in zip(*(batch.column(c).to_pylist() for c in names)):
                if begun and key != conv:
                    out.append(row())
                if not begun or key != conv:
                    conv, begun, n, chars, loss_chars = key, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                chars += len(text)
                valid, state = ok, role
                if part == 1:
                    n, plain = n + 1, template.unescape(text)
                    turns.update(f"{role}\n{plain}\n".encode())
                if counts:
                    plain = template.unescape(text)
                    loss_chars += len(plain)
                    loss.update(plain.encode())
            yield batch_of(DIGEST, out)
        if begun:
            yield batch_of(DIGEST, [row()])
    return read


def conversation_digests(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One DIGEST row per conversation, read back from its segments in order.

    turns_sha256 is over role, line feed, unescaped text, line feed of each turn; loss_sha256 over the
    unescaped text of all segments that count for the loss; formatted_chars counts code points as formatted.
    ``valid``: every turn was allowed and the conversation ends where it may.
    """
    return (segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no", "part")
            .mapInArrow(_digest(template), DIGEST))
