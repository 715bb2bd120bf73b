"""Repair of conversation structure by the cheapest edits.

The rows of a conversation are taken by ``turn`` (nulls first), then role, then text (of both the first 64
characters, then a hash). The first fault of a row counts: ``blank`` (nothing but space), ``duplicate`` (role and
text seen earlier) or ``truncated`` (the last character that is no space is not one of ``.!?``). The edits Keep,
Rerole, Delete and Insert must give role initials that ``GRAMMAR`` accepts; a Delete is required for blank and
duplicate rows. Of the cheapest lists of edits, the one whose initials are least in ASCII order is taken.

1. Rows are judged by native expressions and put in order by a range partitioning on conversation and place, so that
   a busy conversation is spread over many partitions. Duplicates are found inside each, then between their firsts.
2. What a row means for the edits is one letter. A conversation is a string of them, no longer than its audit, and only
   that meets in one place. Costs to the end come from a dynamic programme, which leaves the optimal arcs; their
   nodes are ranked by the audit's first letter, then by its first 2, 4, 8, ... letters, as the rank behind a doubled
   pointer extends the rank in front of it. The ranks select each node's arc, and pointers doubled along
   the selected arcs list the path.
3. Rows and audits meet in one ordered exchange; a conversation streams through one task, row by row and never
   gathered, as the digest of its text is sequential.

Defined cases: null roles and texts are one space; rows without ``conv_id`` are one conversation; rows without ``turn``
come first and count for no gap; repeated rows are duplicates; an empty table gives no row; further columns are
ignored; texts of any length are only streamed, hashed and looked at from the end. ``gaps`` is null where it is more than
a long holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.session import staged

# The automaton of ``(s?(ua)+)?`` over role initials, its accepting states, and what edits cost.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, LEFT_TRUNCATED = 0, 2, 3, 2, 1
INITIALS = "sua"
LEGAL_PAIRS = ("su", "ua", "au")
FAULTS = ("", "truncated", "duplicate", "blank")
SPACE = " \t\n\x0b\x0c\r"

_STATES = len(GRAMMAR)
#: Letters of an audit by rank; 0 is its end.
_LABELS = "\0DIKR"
#: Rows are coded ``A`` to ``P``: initial (one of three, or another) times fault.
_CODES = "ABCDEFGHIJKLMNOP"
#: Rows of conversations that one task solves.
LETTERS_PER_TASK = 100_000
#: Rows whose arcs are spelled out at once.
_BLOCK = 1 << 16

AUDITS = "conv_id BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT, audit STRING"
REPAIRED = "conv_id BIGINT, seq BIGINT, edit STRING, role STRING, text STRING"
DIGESTS = "conv_id BIGINT, repaired_sha256 STRING"


# -- the least of the cheapest edits ------------------------------------------------


def _given(q: int) -> int:
    """The state after a row of the one role that a state of the grammar lets an edit give."""
    (after,) = [t for initial, t in GRAMMAR[q].items() if initial in ROLES]
    return after


def _edits(q: int, code: int) -> list[tuple[str, int, int]]:
    """What may be done with a row in a state: label, cost, next state. No label leads to two states."""
    initial, fault = divmod(code, len(FAULTS))
    found = [("D", DELETE, q)]
    if FAULTS[fault] in ("", "truncated"):
        more = LEFT_TRUNCATED if fault else 0
        if initial < len(INITIALS) and INITIALS[initial] in GRAMMAR[q]:
            found.append(("K", KEEP + more, GRAMMAR[q][INITIALS[initial]]))
        found.append(("R", REROLE + more, _given(q)))
    return found


@lru_cache(maxsize=1 << 16)
def _step(after: tuple[int, ...], code: int | None):
    """Costs in front of a row from those behind it, less their least, which is given apart, and for each state the next one
    by each label that is optimal, else -1. Without a code it is the end of the conversation."""
    if code is None:
        done = [[("\0", 0, 0)] if q in ACCEPTED else [] for q in range(_STATES)]
        costs = [0 if q in ACCEPTED else 1 << 40 for q in range(_STATES)]
    else:
        done = [[(label, cost + after[t], t) for label, cost, t in _edits(q, code)] for q in range(_STATES)]
        costs = [min(cost for _, cost, _ in d) for d in done]
    for _ in range(_STATES):
        costs = [min(c, INSERT + costs[_given(q)]) for q, c in enumerate(costs)]
    arcs = []
    for q in range(_STATES):
        best = {label: t for label, cost, t in [*done[q], ("I", INSERT + costs[_given(q)], _given(q))] if cost == costs[q]}
        arcs.append(tuple(best.get(label, -1) for label in _LABELS))
    least = min(costs)
    return tuple(c - least for c in costs), least, tuple(arcs)


class _Arcs:
    """The optimal arcs between nodes ``row * states + state``; behind the last row, where only the end or an Insert is left,
    stands the goal. Rows are of few kinds, by what follows them, so arcs are kept by kind."""

    def __init__(self, codes: bytes):
        costs, total, kinds = (), 0, {}
        self.kind = np.empty(len(codes) + 1, np.int32)
        for p in range(len(codes), -1, -1):
            costs, least, arcs = _step(costs, codes[p] - ord("A") if p < len(codes) else None)
            total += least
            self.kind[p] = kinds.setdefault(arcs, len(kinds))
        self.cost = total + costs[0]
        self.table = np.array(list(kinds), np.int64)
        self.goal = (len(codes) + 1) * _STATES

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Runs of nodes and their arcs: for each label the next node, or -1."""
        stays = np.array([label == "I" for label in _LABELS])
        for lo in range(0, len(self.kind), _BLOCK):
            kinds = self.kind[lo : lo + _BLOCK]
            states = self.table[kinds]
            rows = np.arange(lo, lo + len(kinds))[:, None, None] + ~stays
            yield slice(lo * _STATES, (lo + len(kinds)) * _STATES), np.where(states < 0, -1, rows * _STATES + states).reshape(-1, len(_LABELS))


def least_audit(codes: str) -> tuple[int, str]:
    """Cost and initials of the least of the cheapest edits of a coded conversation."""
    arcs = _Arcs(codes.encode())
    goal = arcs.goal
    ranks, ahead = np.zeros(goal + 1, np.int64), np.full(goal + 1, goal)
    for part, targets in arcs.blocks():
        ranks[part] = (targets >= 0).argmax(axis=1)
        ahead[part] = np.take_along_axis(targets, ranks[part, None], axis=1)[:, 0]
    # ``ranks`` order the audits' first letters, and ``ahead`` leads past those; each round doubles their number.
    while ahead[0] < goal:
        ranks = np.unique(ranks << 32 | ranks[ahead], return_inverse=True)[1]
        ahead = ahead[ahead]
    label, follow = np.zeros(goal + 1, np.int8), np.full(goal + 1, goal)
    for part, targets in arcs.blocks():
        order = np.where(targets < 0, np.iinfo(np.int64).max, np.arange(len(_LABELS)) << 32 | ranks[targets])
        label[part] = order.argmin(axis=1)
        follow[part] = np.take_along_axis(targets, label[part, None].astype(np.int64), axis=1)[:, 0]
    path = np.zeros(1, np.int64)
    while path[-1] < goal:
        path = np.concatenate([path, follow[path]])
        follow = follow[follow]
    letters = np.frombuffer(_LABELS.encode(), np.uint8)[label[path]]
    return arcs.cost, letters[letters > 0].tobytes().decode()


_short_audit = lru_cache(maxsize=1 << 14)(least_audit)


def _illegal(classes: np.ndarray) -> int:
    """Adjacent role initials that are no legal pair."""
    legal = np.zeros((len(INITIALS) + 1,) * 2, bool)
    for a, b in LEGAL_PAIRS:
        legal[INITIALS.index(a), INITIALS.index(b)] = True
    return int((~legal[classes[:-1], classes[1:]]).sum())


def _solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in AUDITS.split(", ")]
    for frame in frames:
        out = []
        for conv, codes in zip(frame["conv_id"], frame["codes"]):
            cost, audit = (_short_audit if len(codes) <= 64 else least_audit)(codes)
            classes, faults = np.divmod(np.frombuffer(codes.encode(), np.uint8) - ord("A"), len(FAULTS))
            counts = (int((faults == FAULTS.index(f)).sum()) for f in ("blank", "duplicate", "truncated"))
            out.append((conv, *counts, _illegal(classes), cost, audit))
        yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})


# -- judging and ordering -----------------------------------------------------------


def _prepared(turns: DataFrame) -> DataFrame:
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    return turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), text("role"), text("text"))


def _place() -> list[Column]:
    """Where a row stands in its conversation; short columns, as range partitioning samples them."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return [
        F.substring("role", 1, 64).alias("_r"),
        F.substring("text", 1, 64).alias("_t"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("_h"),
    ]


ORDER = ["conv_id", "turn", "_r", "_t", "_h"]


def _judged(turns: DataFrame) -> DataFrame:
    """The rows of conversations by place, without their texts: ``_at`` grows along the order, its upper bits are a part of
    the table of bounded size, and ``_fault`` numbers the fault."""
    ended = F.rtrim("text", F.lit(SPACE))
    kind = F.when(ended == "", 3).when(~F.substring(ended, -1, 1).isin(".", "!", "?"), 1).otherwise(0)
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS))
    initial = F.when((initial == 0) | (F.col("role") == ""), len(INITIALS)).otherwise(initial - 1)
    small = turns.select("conv_id", "turn", *_place(), initial.alias("_initial"), kind.alias("_fault"))
    ranged = small.repartitionByRange(*ORDER, F.monotonically_increasing_id()).sortWithinPartitions(*ORDER)
    placed = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "repair-order")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    inside = Window.partitionBy("conv_id", "_part", "_h").orderBy("_at")
    rows = placed.withColumn("_nth", F.row_number().over(inside))
    between = Window.partitionBy("conv_id", "_h").orderBy("_part")
    firsts = rows.where("_nth = 1").withColumn("_nth", F.row_number().over(between))
    rows = firsts.unionByName(rows.where("_nth > 1"))
    seen = (F.col("_nth") > 1) & (F.col("_fault") != 3)
    return rows.withColumn("_fault", F.when(seen, 2).otherwise(F.col("_fault")))


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, counts of faults, ``illegal`` (adjacent role initials that no grammar allows),
    ``cost`` and ``audit`` of the cheapest edits, ``gaps`` (turn numbers that are missing)."""
    rows = _judged(_prepared(turns))
    code = F.substring(F.lit(_CODES), F.col("_initial") * 4 + F.col("_fault") + 1, F.lit(1))
    joined = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(name)), lambda x: x["code"]), "")
    parts = rows.groupBy("conv_id", "_part").agg(
        joined(F.struct("_at", code.alias("code"))).alias("code"),
        F.min("turn").alias("_first"), F.max("turn").alias("_last"), F.count_distinct("turn").alias("_turns"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("_part", "code", "_first", "_last", "_turns"))).alias("_parts")
    )
    # A turn that two parts share, at the border between them, counts once.
    spans = F.filter("_parts", lambda p: p["_first"].isNotNull())
    shared = F.size(F.filter(F.arrays_zip(
        F.transform(spans, lambda p: p["_last"]).alias("a"), F.transform(F.slice(spans, 2, 2**30), lambda p: p["_first"]).alias("b")
    ), lambda z: z["a"] == z["b"]))
    first = F.array_min(F.transform(spans, lambda p: p["_first"]))
    last = F.array_max(F.transform(spans, lambda p: p["_last"]))
    turns_held = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + p["_turns"]) - shared
    wide = last.cast("decimal(20,0)") - first.cast("decimal(20,0)") + 1 - turns_held
    gaps = F.when(F.size(spans) == 0, F.lit(0).cast("bigint")).otherwise(wide.try_cast("bigint"))
    coded = staged(
        whole.select("conv_id", F.array_join(F.transform("_parts", lambda p: p["code"]), "").alias("codes"), gaps.alias("gaps")),
        "repair-codes",
    )
    # Coded conversations are small but take time to solve, so tasks are cut by letters, not by bytes.
    letters = coded.agg(F.sum(F.length("codes"))).first()[0] or 0
    solved = coded.select("conv_id", "codes").repartition(1 + letters // LETTERS_PER_TASK).mapInPandas(_solve, AUDITS)
    lengths = coded.select(F.col("conv_id").alias("_conv"), "gaps")
    return solved.join(lengths, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


# -- the repaired turns -------------------------------------------------------------


def _edited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each conversation comes as a row with its audit, then its turns in order."""
    conv, audit, k, state, seq, out = None, "", 0, 0, 0, []

    def emit(edit: str, role: str, text: str) -> None:
        nonlocal state, seq
        state = GRAMMAR[state][role[0]]
        out.append((conv, seq, edit, role, text))
        seq += 1

    def wanted() -> str:
        return next(ROLES[i] for i in GRAMMAR[state] if i in ROLES)

    def insert() -> None:
        nonlocal k
        while audit[k : k + 1] == "I":
            emit("I", wanted(), "")
            k += 1

    def table() -> pd.DataFrame:
        made = pd.DataFrame(out, columns=["conv_id", "seq", "edit", "role", "text"])
        out.clear()
        return made.astype({"conv_id": "Int64"})

    for frame in frames:
        for now, own, role, text in zip(frame["conv_id"], frame["audit"], frame["role"], frame["text"]):
            if isinstance(own, str):
                insert()
                conv, audit, k, state, seq = None if pd.isna(now) else int(now), own, 0, 0, 0
                continue
            insert()
            edit = audit[k]
            k += 1
            if edit == "K":
                emit(edit, role, text)
            elif edit == "R":
                emit(edit, wanted(), text)
        yield table()
    insert()
    yield table()


def repair(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns, ``(conv_id, seq, edit, role, text)``, by the ``audits`` of the same rows. ``edit`` is K, R or I; deleted
    rows are gone. Rows of a conversation lie in one partition, in order."""
    none = lambda name, kind="string": F.lit(None).cast(kind).alias(name)
    heads = found.select(
        "conv_id", none("turn", "bigint"), none("role"), none("text"), none("_r"), none("_t"), none("_h", "binary"), "audit"
    )
    rows = _prepared(turns).select("*", *_place(), none("audit"))
    both = heads.unionByName(rows).withColumn("_row", F.col("audit").isNull())
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "_row", *ORDER[1:])
    return ordered.select("conv_id", "audit", "role", "text").mapInPandas(_edited, REPAIRED)


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now, state, out = None, None, []

    def table() -> pd.DataFrame:
        made = pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])
        out.clear()
        return made.astype({"conv_id": "Int64"})

    for frame in frames:
        for conv, seq, role, text in zip(frame["conv_id"], frame["seq"], frame["role"], frame["text"]):
            if seq == 0:
                if state:
                    out.append((now, state.hexdigest()))
                now, state = None if pd.isna(conv) else int(conv), hashlib.sha256()
            state.update(("\n" if seq else "").encode() + f"{role}:{text}".encode())
        yield table()
    if state:
        out.append((now, state.hexdigest()))
    yield table()


def report(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``audits``, with ``repaired_sha256`` of the ``role:text`` lines of the repaired turns, for each ``conv_id`` of
    ``conversations`` (by default of the turns). A conversation without rows has zeros, an empty audit and the hash of nothing."""
    found = staged(audits(turns), "repair-audits")
    digests = repair(turns, found).mapInPandas(_digest, DIGESTS).withColumnRenamed("conv_id", "_of")
    ids = (turns if conversations is None else conversations).select(F.col("conv_id").cast("bigint").alias("_id")).distinct()
    rows = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    rows = rows.join(digests, F.col("_id").eqNullSafe(F.col("_of")), "left")
    number = lambda name: F.when(F.col("audit").isNull(), F.lit(0).cast("bigint")).otherwise(F.col(name)).alias(name)
    return rows.select(
        F.col("_id").alias("conv_id"),
        *[number(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
