"""Chat formatting with a finite-state machine over roles.

A declarative template names the marks around a turn, the roles whose text is
learned, and which role may follow which. Conversations stream through the
machine turn by turn; each turn becomes text segments with a loss flag. Control
strings inside texts are escaped so that the output can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgauge.llm.frames import map_batches

START = ""  # state before the first turn


def _default_order() -> dict[str, tuple[str, ...]]:
    return {
        START: ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    }


@dataclass(frozen=True)
class ChatTemplate:
    """Marks, learned roles and the transitions of the role machine.

    Both marks begin with ``<|``, which escaping keeps out of roles and texts.
    """

    open_mark: str = "<|im_start|>"
    close_mark: str = "<|im_end|>"
    after_role: str = "\n"
    after_turn: str = "\n"
    learned: tuple[str, ...] = ("assistant",)
    order: dict[str, tuple[str, ...]] = field(default_factory=_default_order)
    final: tuple[str, ...] = ("assistant",)


_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|`` and so on."""
    return _MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def turn_segments(role: str, text: str, template: ChatTemplate) -> list[tuple[str, bool]]:
    """(text, loss) segments of one turn; marks are never under the loss."""
    return [
        (template.open_mark + escape_role(role) + template.after_role, False),
        (escape(text), role in template.learned),
        (template.close_mark + template.after_turn, False),
    ]


def _none(value):
    return None if pd.isna(value) else value


def _format(template: ChatTemplate):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, conv, state, broken, position = True, None, START, None, 0
        for pdf in batches:
            rows = []
            for key, role, text in zip(pdf["conv"].astype(object), pdf["role"], pdf["text"], strict=True):
                key, role, text = _none(key), _none(role) or "", _none(text) or ""
                if first or key != conv:
                    first, conv, state, broken, position = False, key, START, None, 0
                if broken is None and role not in template.order.get(state, ()):
                    broken = position // 3
                state = role
                for segment, loss in turn_segments(role, text, template):
                    rows.append((key, position, segment, loss, broken, broken is None and role in template.final))
                    position += 1
            out = pd.DataFrame(rows, columns=["conv", "position", "segment", "loss", "broken_at", "complete"])
            yield out.astype({"conv": "Int64", "broken_at": "Int64"})

    return run


def format_chat(
    turns: DataFrame,
    template: ChatTemplate | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv, position, segment, loss, broken_at, complete): the segments of each conversation in order.

    Turns are ordered by turn, then role and text, null first; repeated rows are
    turns of their own. Null roles and texts are empty. Rows of a null
    conversation are one conversation. ``broken_at`` is the first turn that the
    machine does not admit, so far (null: none); ``complete`` says whether the
    conversation could end here. Conversations that break the order are formatted
    all the same. An empty table gives an empty result, other columns are ignored.

    Rows are dealt out by conversation and sorted; each task then streams its rows,
    so a conversation of any length needs the memory of one batch.
    """
    rows = turns.select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text"),
    )
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    schema = "conv bigint, position bigint, segment string, loss boolean, broken_at bigint, complete boolean"
    return map_batches(rows.select("conv", "role", "text"), _format(template or ChatTemplate()), schema)


class _Reader:
    """Reads the segments of one conversation back."""

    def __init__(self, template: ChatTemplate):
        self.template, self.turns, self.formatted, self.learned = template, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.held: list[str] = []

    def add(self, segment: str, loss: bool) -> None:
        self.formatted += len(segment)
        if loss:
            plain = unescape(segment)
            self.learned += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        self.held.append(segment)
        t = self.template
        if segment.endswith(t.close_mark + t.after_turn):
            whole = "".join(self.held)
            self.held = []
            if not whole.startswith(t.open_mark):
                raise ValueError("a turn does not begin with its mark")
            role, text = whole[len(t.open_mark) :].split(t.after_role, 1)
            text = text.removesuffix(t.close_mark + t.after_turn)
            self.all.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1


def _read(template: ChatTemplate):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, conv, broken, complete = None, None, None, False

        def row() -> tuple:
            if reader.held:
                raise ValueError("a turn has no end")
            return (
                conv, reader.turns, reader.all.hexdigest(), reader.learned, reader.loss.hexdigest(),
                reader.formatted, complete, broken,
            )

        def frame(rows: list[tuple]) -> pd.DataFrame:
            names = [c.split()[0] for c in DIGEST.split(", ")]
            return pd.DataFrame(rows, columns=names).astype({"conv": "Int64", "broken_at": "Int64"})

        for pdf in batches:
            rows = []
            columns = (pdf["conv"], pdf["segment"], pdf["loss"], pdf["broken_at"], pdf["complete"])
            for key, segment, loss, at, done in zip(*(c.astype(object) for c in columns), strict=True):
                key = _none(key)
                if reader is None or key != conv:
                    if reader is not None:
                        rows.append(row())
                    reader, conv = _Reader(template), key
                reader.add(segment, loss)
                broken, complete = _none(at), done
            yield frame(rows)
        if reader is not None:
            yield frame([row()])

    return run


DIGEST = (
    "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, complete boolean, broken_at bigint"
)


def read_back(segments: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation, parsed from the segments as ``format_chat`` hands them on.

    The segments of a conversation must stand together and in order. Raises an
    error when the output is not made of whole turns.
    """
    return map_batches(segments, _read(template or ChatTemplate()), DIGEST)
