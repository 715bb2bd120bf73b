r"""Chat formatting by grammar round trip.

A conversation is written as ``<s>`` and its turns, each ``open text close``
and a line end. Every turn is parsed back at once; where the parser does not
give the same role and text, the control strings in them are escaped and the
turn is parsed again, until both are identical.

Grammar, in which a control string counts only without a backslash before it::

    conversation := "<s>" turn*
    turn := "[SYS] " text " [/SYS]\n" | "[INST] " text " [/INST]\n" | "[ANS] " text " </s>\n"
          | "[ROLE] " role " [TEXT] " text " [/ROLE]\n"

An escaped text has one backslash more before each control string (and before
the backslashes that already stand there), so that escaping is reversible.

Defined cases: null role or text is empty; rows are ordered by turn (nulls
first), then role, then text, so repeated rows stay as repeated turns; rows
without ``conv_id`` are one conversation; an empty table gives no row. One
conversation is read by one task, row by row and never gathered, as its digests
are sequential. A very long text is one row and is held whole; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The template.
BOS = "<s>"
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
LOSS_ROLE = "assistant"

_BY_OPEN = {opened: (role, closed) for role, (opened, closed) in MARKS.items()}
_CONTROL = re.compile(
    r"(\\*)(" + "|".join(re.escape(x) for x in [BOS, *(m for pair in MARKS.values() for m in pair), *OTHER]) + ")"
)

SEGMENTS = "conv_id BIGINT, seq BIGINT, role STRING, segment STRING, loss_start INT, loss_end INT"
DIGESTS = (
    "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, formatted_chars BIGINT"
)


class GrammarError(ValueError):
    """The text is not a formatted conversation."""


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][1:] if m[1] else m[0], text)


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation or a part of one."""
    marks = [(m[2], m.start(), m.end()) for m in _CONTROL.finditer(text) if not m[1]]
    turns, at, k = [], 0, 0

    def take(name: str | None = None) -> tuple[str, str]:
        """The next control string and the text before it."""
        nonlocal at, k
        if k == len(marks) or name is not None and marks[k][0] != name:
            raise GrammarError(f"expected {name or 'a control string'} after position {at}")
        mark, start, end = marks[k]
        before, at, k = text[at:start], end, k + 1
        return mark, before

    def body(name: str) -> str:
        _, inner = take(name)
        if len(inner) < 2 or inner[0] != " " or inner[-1] != " ":
            raise GrammarError(f"no space around the text before position {at}")
        return unescape(inner[1:-1])

    while at < len(text):
        mark, before = take()
        if before:
            raise GrammarError(f"text outside a turn before position {at}")
        if mark == BOS:
            continue
        if mark == OTHER[0]:
            role = body(OTHER[1])
            turns.append((role, body(OTHER[2])))
        elif mark in _BY_OPEN:
            role, closed = _BY_OPEN[mark]
            turns.append((role, body(closed)))
        else:
            raise GrammarError(f"{mark} opens no turn")
        if text[at : at + 1] != "\n":
            raise GrammarError(f"no line end at position {at}")
        at += 1
    return turns


def _write(role: str, text: str, shown_role: str, shown: str) -> tuple[str, int, int]:
    if role in MARKS:
        opened, closed = MARKS[role]
        head = f"{opened} "
    else:
        head, closed = f"{OTHER[0]} {shown_role} {OTHER[1]} ", OTHER[2]
    return f"{head}{shown} {closed}\n", len(head), len(head) + len(shown)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as formatted, and where its text starts and ends in it."""
    shown_role, shown = role, text
    for _ in range(3):
        piece = _write(role, text, shown_role, shown)
        try:
            if parse(piece[0]) == [(role, text)]:
                return piece
        except GrammarError:
            pass
        shown_role, shown = escape(role), escape(text)
    raise AssertionError(f"turn does not survive the round trip: {role!r}")


def _render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, seq = object(), 0
    for frame in frames:
        out = []
        for conv, role, text in zip(frame["conv_id"], frame["role"], frame["text"]):
            conv = None if pd.isna(conv) else int(conv)
            seq = seq + 1 if conv == last else 0
            piece, start, end = render_turn(role, text)
            if seq == 0:
                piece, start, end = BOS + piece, start + len(BOS), end + len(BOS)
            loss = role == LOSS_ROLE
            out.append((conv, seq, role, piece, start if loss else None, end if loss else None))
            last = conv
        columns = ["conv_id", "seq", "role", "segment", "loss_start", "loss_end"]
        made = pd.DataFrame(out, columns=columns)
        yield made.astype({"conv_id": "Int64", "loss_start": "Int32", "loss_end": "Int32"})


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss, self.chars = conv, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start, end) -> None:
        self.chars += len(segment)
        for role, text in parse(segment):
            self.turns += 1
            self.turn_hash.update(f"{role}\n{text}\n".encode())
        if not pd.isna(start):
            masked = unescape(segment[int(start) : int(end)])
            self.loss += len(masked)
            self.loss_hash.update(masked.encode())

    def row(self) -> tuple:
        digests = self.turn_hash.hexdigest(), self.loss_hash.hexdigest()
        return self.conv, self.turns, digests[0], self.loss, digests[1], self.chars


def _read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, columns = None, [c.split()[0] for c in DIGESTS.split(", ")]

    def table(rows):
        return pd.DataFrame(rows, columns=columns).astype({"conv_id": "Int64"})

    for frame in frames:
        done = []
        names = ("conv_id", "seq", "segment", "loss_start", "loss_end")
        for conv, seq, segment, start, end in zip(*(frame[c] for c in names)):
            if seq == 0:
                if now:
                    done.append(now.row())
                now = _Digest(None if pd.isna(conv) else int(conv))
            now.add(segment, start, end)
        if done:
            yield table(done)
    if now:
        yield table([now.row()])


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per turn, ``(conv_id, seq, role, segment, loss_start, loss_end)``:
    the segments of a conversation in order of ``seq``, joined, are its formatted
    text; the mask marks, in each segment, the text that is trained on. Rows of a
    conversation lie in one partition, in order."""
    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    ordered = (
        turns.select(F.col("conv_id").cast("bigint"), F.col("turn"), text("role"), text("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.mapInPandas(_render, SEGMENTS)


def read_back(segments: DataFrame) -> DataFrame:
    """Parse what ``format_chat`` wrote (in its partitions and order) and give
    each conversation's counts and digests."""
    return segments.mapInPandas(_read_back, DIGESTS)
