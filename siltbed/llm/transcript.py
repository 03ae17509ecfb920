"""Roles of transcript lines by a hidden Markov model, and canonical turns.

A transcript is its lines, in however many pieces they come: borders of pieces tell nothing.
A state is a role and whether a line begins its turn or goes on with it. What a line shows is
its speaker marker, if any, and classes of its form, each by itself. Viterbi runs in segments: the best score
from every state before a segment to every state at its end is a small table, the tables of a
conversation are chained to find the state at each border, and each segment is then traced
back by itself. So a conversation of any length is shared out over tasks, and the result is
that of Viterbi over the whole of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

ROLES = ("system", "user", "assistant")
# Begin and go on for each role, then the state before the first line.
STATES = 2 * len(ROLES)
START = STATES
# Pieces whose lines are numbered together, and lines of a conversation in a segment.
PIECES, SEGMENT = 64, 256
SMOOTHING = 0.5
# Share of what all states show in what a state shows, so that what none ever showed tells nothing.
SHARED = 0.01

# The words that name a speaker before a colon or in a heading.
SPEAKERS = {
    "system": ("system", "sys", "instructions"),
    "user": ("user", "human", "customer", "question", "q", "instruction", "prompt"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "response", "model"),
}
_NAMED = {name: role for role, names in SPEAKERS.items() for name in names}
_MARKER = re.compile(
    r"^\s*(?:(?:\#+|\*\*|\[|<\|?)\s*)?(" + "|".join(sorted(_NAMED, key=len, reverse=True)) + r")(?:\s*(?:\*\*|\]|\|?>))?\s*(?::|$)(?:\*\*)?\s*", re.I
)


def split_marker(line: str) -> tuple[str | None, str]:
    """The role that a line's marker names, and the line without the marker."""
    m = _MARKER.match(line)
    return (_NAMED[m[1].lower()], line[m.end():]) if m else (None, line)


# Classes of a line: marker x question x length x a break before it.
MARKERS, LENGTHS = (None, *ROLES), (0, 40, 120, 400)
CLASSES = (len(MARKERS), 2, len(LENGTHS), 2)
SYMBOLS = int(np.prod(CLASSES))


def symbol(line: str, after_break: bool) -> int:
    role, rest = split_marker(line)
    length = sum(len(rest) > x for x in LENGTHS[1:])
    code = MARKERS.index(role)
    for value, size in zip(("?" in rest, length, after_break), CLASSES[1:]):
        code = code * size + int(value)
    return code


@dataclass
class RoleModel:
    """Logarithms: from the state before (or START) to the next, and of what a state shows."""

    moves: np.ndarray  # (STATES + 1) x STATES
    shows: np.ndarray  # STATES x SYMBOLS

    @classmethod
    def from_counts(cls, moves: np.ndarray, shows: np.ndarray) -> RoleModel:
        moves = moves + SMOOTHING
        for before in range(STATES + 1):
            for after in range(STATES):
                # A line goes on with the turn before it, so with its role; a first line begins one.
                if after % 2 and (before == START or before // 2 != after // 2):
                    moves[before, after] = 0
        with np.errstate(divide="ignore"):
            return cls(np.log(moves / moves.sum(axis=1, keepdims=True)), cls._shown(shows.reshape(STATES, *CLASSES)).reshape(STATES, SYMBOLS))

    @staticmethod
    def _shown(counts: np.ndarray) -> np.ndarray:
        """Class by class, so that a marker tells the same on lines of any form."""
        total = np.zeros(counts.shape)
        for axis in range(1, counts.ndim):
            own = counts.sum(axis=tuple(a for a in range(1, counts.ndim) if a != axis))
            every = (own.sum(axis=0) + SMOOTHING) / (own + SMOOTHING / STATES).sum()
            seen = own.sum(axis=1, keepdims=True)
            rate = np.where(seen > 0, (1 - SHARED) * own / np.maximum(seen, 1) + SHARED * every, every)
            total += np.log(rate).reshape(STATES, *[-1 if a == axis else 1 for a in range(1, counts.ndim)])
        return total

    def passage(self, symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """From each state before the lines (START last) to each at their end: the best score, and whether that way begins a turn."""
        best = self.moves + self.shows[:, symbols[0]]
        opens = np.broadcast_to(np.arange(STATES) % 2 == 0, best.shape)
        for s in symbols[1:]:
            ways = best[:, :, None] + self.moves[None, :STATES]
            before = ways.argmax(axis=1)
            best = np.take_along_axis(ways, before[:, None, :], axis=1)[:, 0] + self.shows[:, s]
            opens = np.take_along_axis(opens, before, axis=1)
        return best, np.ascontiguousarray(opens)

    def trace(self, symbols: list[int], before: int, last: int) -> list[int]:
        """The best states of the lines between two given states."""
        best, back = self.moves[before] + self.shows[:, symbols[0]], []
        for s in symbols[1:]:
            ways = best[:, None] + self.moves[:STATES]
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + self.shows[:, s]
        states = [last]
        for step in reversed(back):
            states.append(int(step[states[-1]]))
        return states[::-1]


def chain(passages: list[np.ndarray]) -> list[int]:
    """The state at the end of each segment of a conversation."""
    best, back = passages[0][START], []
    for passage in passages[1:]:
        ways = best[:, None] + passage[:STATES]
        back.append(ways.argmax(axis=0).astype(np.int8))
        best = ways.max(axis=0)
    states = [int(best.argmax())]
    for step in reversed(back):
        states.append(int(step[states[-1]]))
    return states[::-1]


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = tuple(row[k] for k in keys)
            if own != at:
                if rows:
                    yield at, rows
                at, rows = own, []
            rows.append(row)
    if rows:
        yield at, rows


def _batches_of(groups: Iterator, size: int = 256) -> Iterator[list]:
    """Groups in lists, so that few record batches are made."""
    held = []
    for group in groups:
        held.append(group)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _lines(messages: DataFrame, conversation: str, position: str, text: str, role: str | None = None) -> DataFrame:
    """Lines of every conversation that are not blank, numbered over all its pieces.

    Pieces are in order of position, ties by text, and joined by line ends. ``before`` is the
    number of the last such line before (null for the first), ``opens`` whether a line is the
    first of its piece. Numbers are summed within stretches of PIECES positions, then over
    the stretches, so no task has a whole conversation.
    """
    split = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1)
    rows = messages.select(
        F.col(conversation).alias("conversation"), F.coalesce(F.floor(F.col(position) / PIECES), F.lit(-1)).cast("long").alias("stretch"), F.col(position).alias("position"),
        F.col(text).cast("string").alias("text"), F.size(split).cast("long").alias("n"),
        F.filter(F.transform(split, lambda x, k: F.struct(k.alias("k"), x.alias("text"))), lambda x: x["text"].rlike(r"\S")).alias("found"), *([F.col(role).alias("role")] if role else []),
    ).withColumn("final", F.when(F.size("found") > 0, F.element_at("found", -1)["k"].cast("long")))
    earlier = (Window.unboundedPreceding, -1)
    within = Window.partitionBy("conversation", "stretch").orderBy("position", "text").rowsBetween(*earlier)
    placed = rows.withColumn("start", F.coalesce(F.sum("n").over(within), F.lit(0))).drop("text")
    placed = placed.withColumn("final", F.col("start") + F.col("final")).withColumn("text_before", F.max("final").over(within.orderBy("start").rowsBetween(*earlier)))
    over = Window.partitionBy("owner").orderBy("part").rowsBetween(*earlier)
    stretches = placed.groupBy(F.col("conversation").alias("owner"), F.col("stretch").alias("part")).agg(F.sum("n").alias("n"), F.max("final").alias("final"))
    stretches = stretches.withColumn("offset", F.coalesce(F.sum("n").over(over), F.lit(0)))
    stretches = stretches.withColumn("before_all", F.max(F.col("offset") + F.col("final")).over(over)).select("owner", "part", "offset", "before_all")
    placed = placed.join(stretches, F.col("conversation").eqNullSafe(F.col("owner")) & (F.col("stretch") == F.col("part")))
    lead = F.coalesce(F.col("offset") + F.col("text_before"), F.col("before_all"))
    # Each line with the one before it in its piece, so that no row carries more than its line.
    linked = F.transform("found", lambda x, at: F.struct(x["k"].alias("k"), x["text"].alias("text"), F.get("found", at - 1)["k"].alias("before")))
    lines = placed.select("conversation", "position", *(["role"] if role else []), (F.col("offset") + F.col("start")).alias("start"), lead.alias("lead"), F.explode(linked).alias("line"))
    number = F.col("start") + F.col("line.k")
    previous = F.coalesce(F.col("start") + F.col("line.before"), F.col("lead"))
    return lines.select(
        "conversation", F.floor(number / SEGMENT).cast("long").alias("segment"), number.alias("number"), previous.alias("before"), "position",
        F.col("line.text").alias("text"), F.col("line.before").isNull().alias("opens"), *(["role"] if role else []),
    )


def _dealt(lines: DataFrame, *also: str) -> DataFrame:
    return lines.repartition("conversation", "segment").sortWithinPartitions("conversation", "segment", *also, "number")


def _gap(row: dict) -> int:
    """Blank lines right before a line; those before the first of all do not count."""
    return 0 if row["before"] is None else row["number"] - row["before"] - 1


def _symbols(rows: list[dict]) -> list[int]:
    return [symbol(row["text"], _gap(row) > 0) for row in rows]


def train(messages: DataFrame, *, conversation: str = "conv_id", position: str = "turn", text: str = "text", role: str = "role") -> RoleModel:
    """Counts over all messages whose role is given: of moves within segments and of what lines show.

    A message is a turn of its role, its blank lines aside. Messages of other or null roles are passed over. Without
    any the model is even.
    """
    rows = _dealt(_lines(messages.where(F.col(role).isin(*ROLES)), conversation, position, text, role))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, shows = np.zeros((STATES + 1, STATES), np.int64), np.zeros((STATES, SYMBOLS), np.int64)
        for _, group in _groups(batches, "conversation", "segment"):
            before = START if group[0]["before"] is None else None
            for row, shown in zip(group, _symbols(group)):
                state = 2 * ROLES.index(row["role"]) + (not row["opens"])
                if before is not None:
                    moves[before, state] += 1
                shows[state, shown] += 1
                before = state
        flat = np.concatenate([moves.ravel(), shows.ravel()])
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(flat[used])], ["place", "n"])

    counts = np.zeros((STATES + 1) * STATES + STATES * SYMBOLS)
    for row in rows.mapInArrow(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[row.place] = row.n
    cut = (STATES + 1) * STATES
    return RoleModel.from_counts(counts[:cut].reshape(STATES + 1, STATES), counts[cut:].reshape(STATES, SYMBOLS))


def render(role: str, text: str, begins: bool, ends: bool, glue: str = "\n") -> str:
    return (f"<|im_start|>{role}\n" if begins else glue) + text + ("<|im_end|>\n" if ends else "")


def parse(
    messages: DataFrame, model: RoleModel, *, conversation: str = "conv_id", position: str = "turn", text: str = "text", stored: Callable[[DataFrame, str], DataFrame] = lambda rows, _: rows
) -> DataFrame:
    """Turns of transcripts whose roles are not given, in canonical form.

    Input: transcripts as whole texts or in pieces (messages, pages, lines) in the order of
    ``position``; pieces are joined by line ends and need not begin or end with a turn. Returns a row for each turn, or
    for each part of one that goes on in the next segment: the conversation, ``segment``,
    ``part`` (order in it), ``position`` (of its first piece), ``role``, ``begins``, ``ends``, ``lines``,
    ``content`` without the marker but with the blank lines inside the turn, and ``rendered``, which put together in order are the
    canonical transcript. Null texts are empty lines; conversations without any text have no turns; null positions come first, null
    conversations are one conversation; pieces with the same position go by text. ``stored``
    may write a small table that is used twice.
    """
    lines = _lines(messages, conversation, position, text)
    dealt = _dealt(lines)
    owner_type, position_type = (to_arrow_type(dealt.schema[c].dataType) for c in ("conversation", "position"))
    kind, place = dealt.schema["conversation"].dataType.simpleString(), dealt.schema["position"].dataType.simpleString()

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conversation", "segment", "passage", "opens", "bare"]
        for batch in _batches_of(_groups(batches, "conversation", "segment")):
            tables = [model.passage(_symbols(rows)) for _, rows in batch]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in batch], owner_type), pa.array([k[1] for k, _ in batch], pa.int64()), pa.array([t.astype("<f8").tobytes() for t, _ in tables], pa.binary()), pa.array([f.tobytes() for _, f in tables], pa.binary()),
                 pa.array([split_marker(rows[-1]["text"])[1] == "" for _, rows in batch])], names
            )

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (owner,), rows in _groups(batches, "conversation"):
            ends = chain([np.frombuffer(r["passage"], "<f8").reshape(STATES + 1, STATES) for r in rows])
            before, n = [START, *ends[:-1]], len(rows)
            opens = [np.frombuffer(r["opens"], bool).reshape(STATES + 1, STATES)[b, e] for r, b, e in zip(rows, before, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([owner] * n, owner_type), pa.array([r["segment"] for r in rows], pa.int64()), pa.array(before, pa.int32()), pa.array(ends, pa.int32()), pa.array([*map(bool, opens[1:]), True]), pa.array([False, *[r["bare"] for r in rows[:-1]]])],
                ["conversation", "segment", "entered", "last", "ends", "bare"],
            )

    tables = dealt.mapInArrow(passages, f"conversation {kind}, segment long, passage binary, opens binary, bare boolean")
    borders = tables.repartition("conversation").sortWithinPartitions("conversation", "segment").mapInArrow(chained, f"conversation {kind}, segment long, entered int, last int, ends boolean, bare boolean")
    borders = stored(borders, "borders")
    given, known = (("number", "long"), ("before", "long"), ("position", place), ("text", "string")), (("entered", "int"), ("last", "int"), ("ends", "boolean"), ("bare", "boolean"))
    none = lambda columns: [F.lit(None).cast(t).alias(c) for c, t in columns]
    side = lines.select("conversation", "segment", F.lit(1).alias("kind"), *[c for c, _ in given], *none(known))
    head = borders.select("conversation", "segment", F.lit(0).alias("kind"), *none(given), *[c for c, _ in known])
    both = _dealt(head.union(side), "kind")

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conversation", "segment", "part", "position", "role", "begins", "ends", "lines", "content", "rendered"]
        kinds = [owner_type, pa.int64(), pa.int32(), position_type, pa.string(), pa.bool_(), pa.bool_(), pa.int32(), pa.string(), pa.string()]
        for group in _batches_of(_groups(batches, "conversation", "segment")):
            out = []
            for (owner, segment), rows in group:
                border, rows = rows[0], rows[1:]
                states = model.trace(_symbols(rows), border["entered"], border["last"])
                first = [k for k, state in enumerate(states) if k == 0 or state % 2 == 0]
                for part, (start, end) in enumerate(zip(first, [*first[1:], len(states)])):
                    role, begins = ROLES[states[start] // 2], states[start] % 2 == 0
                    own = [row["text"] for row in rows[start:end]]
                    gaps = [_gap(row) for row in rows[start:end]]
                    if begins:
                        own[0] = split_marker(own[0])[1]
                        # A marker on a line of its own is no line of the content.
                        drop = len(own) > 1 and not own[0]
                        own, gaps = own[drop:], gaps[drop:]
                    # What goes on in the next segment ends there.
                    ends = end < len(states) or border["ends"]
                    content = own[0] + "".join("\n" * (gap + 1) + line for gap, line in zip(gaps[1:], own[1:]))
                    glue = "" if border["bare"] and border["entered"] % 2 == 0 else "\n" * (gaps[0] + 1)
                    out.append((owner, segment, part, rows[start]["position"], role, begins, ends, end - start, content, render(role, content, begins, ends, glue)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names)

    return both.mapInArrow(turns, f"conversation {kind}, segment long, part int, position {place}, role string, begins boolean, ends boolean, lines int, content string, rendered string").withColumnRenamed("conversation", conversation)
