"""Chat formatting with a loss mask.

A declarative template and a finite-state machine over roles.  The machine walks the turns of each
conversation in order, marks turns that come out of order, and emits text segments, each flagged
whether a training loss counts on it.  Rows are sorted by conversation and turn and streamed, so a
conversation of any length passes through a task without being held there.

Control strings inside texts are escaped reversibly; ``read_back`` parses the formatted text into
the turns again.

Defined cases: null roles and texts count as empty; rows of equal turn follow by role and text;
a null turn comes first; the null conversation is one like any other.  A turn out of order is still
formatted, with ``in_order`` false.  Roles unknown to the template never carry a loss.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from driftwell.llm.common import ship_package


@dataclass(frozen=True)
class Template:
    """How turns are written, which roles may follow which, and where a loss counts."""

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_turn: str = "\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    # state (the last role, "" at the beginning) -> roles that may come next
    moves: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user", "tool"}),
            "tool": frozenset({"assistant"}),
        }
    )

    def escape(self, text: str) -> str:
        r"""Backslashes are doubled and ``<|`` becomes ``<\|``: no control string is left."""
        return text.replace("\\", "\\\\").replace("<|", "<\\|")

    def unescape(self, text: str) -> str:
        return re.sub(r"\\([\\|n])", lambda m: "\n" if m[1] == "n" else m[1], text)

    def escape_role(self, role: str) -> str:
        """A role stands on one line."""
        return self.escape(role).replace("\n", "\\n")


CHATML = Template()

SEGMENTS = "conv_id long, turn_no long, segment_no int, text string, loss boolean, in_order boolean"


def format_conversations(
    rows: DataFrame,
    *,
    template: Template = CHATML,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Segments of each conversation, in order within their partition: ``SEGMENTS``.

    Segment 0 of a turn is its header, 1 the escaped text, 2 the end mark.
    """

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state, number = object(), "", 0
        for batch in batches:
            out = []
            for key, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                key = None if pd.isna(key) else int(key)
                if key != conv:
                    conv, state, number = key, "", 0
                allowed = role in template.moves.get(state, frozenset())
                state = role
                loss = role in template.loss_roles
                header = template.start + template.escape_role(role) + template.after_role
                out.append((key, number, 0, header, False, allowed))
                out.append((key, number, 1, template.escape(text), loss, allowed))
                out.append((key, number, 2, template.end + template.after_turn, False, allowed))
                number += 1
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SEGMENTS.split(", ")]).astype({"conv_id": "Int64"})

    ship_package(rows.sparkSession)
    turns = rows.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInPandas(emit, SEGMENTS)


class ReadBack:
    """Parses the segments of one conversation; holds one turn at a time."""

    def __init__(self, template: Template):
        self.template = template
        self.turn = re.compile(
            re.escape(template.start) + r"(.*?)" + re.escape(template.after_role) + r"(.*?)"
            + re.escape(template.end + template.after_turn),
            re.DOTALL,
        )
        self.buffer = ""
        self.turns = self.loss_chars = self.formatted_chars = 0
        self.all_in_order = True
        self.text_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, loss: bool, in_order: bool) -> None:
        self.formatted_chars += len(text)
        self.all_in_order &= bool(in_order)
        if loss:
            plain = self.template.unescape(text)
            self.loss_chars += len(plain)
            self.loss_hash.update(plain.encode("utf-8", "replace"))
        self.buffer += text
        if text.endswith(self.template.end + self.template.after_turn):
            found = self.turn.fullmatch(self.buffer)
            role, said = map(self.template.unescape, found.groups())
            self.text_hash.update(f"{role}\n{said}\n".encode("utf-8", "replace"))
            self.turns += 1
            self.buffer = ""


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean"
)


def digest_segments(segments: DataFrame, *, template: Template = CHATML) -> DataFrame:
    """One row per conversation, parsed back from its segments; see ``ReadBack``."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, reader = None, None

        def row() -> tuple:
            return (
                key, reader.turns, reader.text_hash.hexdigest(), reader.loss_chars, reader.loss_hash.hexdigest(),
                reader.formatted_chars, reader.all_in_order,
            )

        columns = [c.split()[0] for c in DIGESTS.split(", ")]
        for batch in batches:
            out = []
            for conv, text, loss, in_order in zip(batch["conv_id"], batch["text"], batch["loss"], batch["in_order"]):
                conv = None if pd.isna(conv) else int(conv)
                if reader is None or conv != key:
                    if reader is not None:
                        out.append(row())
                    key, reader = conv, ReadBack(template)
                reader.feed(text, loss, in_order)
            yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})
        if reader is not None:
            yield pd.DataFrame([row()], columns=columns).astype({"conv_id": "Int64"})

    return segments.mapInPandas(digest, DIGESTS)
