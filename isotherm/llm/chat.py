"""Chat formatting: turns to marked text with loss flags, by a template and a finite-state machine.

The template says what stands around a turn of each role, which roles may follow
which, and whose text is learnt. Its control strings are escaped inside texts, so
that the formatted text can be read back without loss.

Rows are ranged by conversation and turn, so a conversation of any size is spread
over tasks. A task can't see how its first conversation began, but it can tell
for every state of the machine where its rows lead from there. These small
functions, one row per task, are composed in order and give each task its state.

Defined cases: null texts are empty, null roles are the role ``""``; equal turns
go by role, then text; null conversations are one conversation; null turns come
first. A role that the template does not know is marked by its name and leads to
the state ``broken``, as does a turn out of order; all turns are formatted
nevertheless, and the state tells whether the conversation is valid.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.frames import width
from isotherm.session import configure, cut_lineage

START, BROKEN = "start", "broken"
#: Characters of a conversation that one row carries at most, if no turn alone is longer.
PIECE_CHARS = 1 << 20


def _turns() -> dict[str, tuple[str, str]]:
    return {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}


def _order() -> dict[str, frozenset[str]]:
    return {
        START: frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    }


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings around the turns of each role, and the machine over roles.

    A role not in ``around`` is written between the ``named`` strings, before a
    text that ends with the third of them. ``follows`` maps a state (``start`` or
    the role of the last turn) to the roles allowed next.
    """

    around: dict[str, tuple[str, str]] = field(default_factory=_turns)
    named: tuple[str, str, str] = ("<<ROLE>>", "<</ROLE>>", "<</TURN>>")
    follows: dict[str, frozenset[str]] = field(default_factory=_order)
    learnt: frozenset[str] = frozenset({"assistant"})
    final: frozenset[str] = frozenset({"assistant"})
    escape: str = "\\"

    def __post_init__(self):
        controls = [*(c for pair in self.around.values() for c in pair), *self.named]
        mark = re.escape(self.escape)
        put = "|".join(f"{re.escape(c[0])}(?=(?:{mark})*{re.escape(c[1:])})" for c in controls)
        take = "|".join(f"(?<={re.escape(c[0])}){mark}(?=(?:{mark})*{re.escape(c[1:])})" for c in controls)
        for name, pattern in (("_put", put), ("_take", take), ("_control", "|".join(map(re.escape, controls)))):
            object.__setattr__(self, name, re.compile(pattern, re.DOTALL))

    @property
    def states(self) -> list[str]:
        return [*self.follows, BROKEN]

    def next_state(self, state: str, role: str) -> str:
        return role if role in self.follows.get(state, ()) and role in self.follows else BROKEN

    def escaped(self, text: str) -> str:
        """One escape mark more behind the first character of each control string, whether it has none or many."""
        return self._put.sub(lambda found: found[0] + self.escape, text)

    def unescaped(self, text: str) -> str:
        """One escape mark less in each control string that has any."""
        return self._take.sub("", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn as three (formatted text, in the loss) parts."""
        if role in self.around:
            head, tail = self.around[role]
        else:
            head, tail = self.named[0] + self.escaped(role) + self.named[1], self.named[2]
        return [(head, False), (self.escaped(text), role in self.learnt), (tail, False)]

    def read_turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Roles and texts of formatted turns; control strings that aren't escaped part them."""
        roles = {head: role for role, (head, _) in self.around.items()}
        found = self._control.finditer(formatted)
        for head in found:
            last, role = head, roles.get(head[0])
            if role is None:
                last = next(found)
                role = self.unescaped(formatted[head.end() : last.start()])
            yield role, self.unescaped(formatted[last.end() : next(found).start()])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _batched(rows: Iterable[tuple], schema: pa.Schema, most_rows: int = 2048, most_chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= most_rows or chars >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _leads(template: ChatTemplate):
    """Task: one row on where its rows lead the machine."""
    states = template.states
    schema = pa.schema(
        [("task", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("alone", pa.bool_()), ("leads", pa.list_(pa.string()))]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        alone, at, seen = True, list(states), False
        for conv, _, role, _ in _rows(batches):
            if not seen:
                first, last, seen = conv, conv, True
            elif conv != last:
                last, alone, at = conv, False, [START] * len(states)
            at = [template.next_state(state, role) for state in at]
        if seen:
            row = (TaskContext.get().partitionId(), first, last, alone, at)
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

    return task


def entry_states(leads: list, states: list[str]) -> dict[int, str]:
    """The machine's state before the first row of each task, from the tasks' leads in order."""
    entries, conv, state = {}, object(), START
    for row in sorted(leads, key=lambda r: r["task"]):
        entries[row["task"]] = enter = state if row["first"] == conv else START
        conv, state = row["last"], row["leads"][states.index(enter)] if row["alone"] else row["leads"][0]
    return entries


def format_chats(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Segments in order: ``conv_id, task, nth, turn, role, part, text, loss, state``.

    ``turns`` has ``conv_id, turn, role, text``. ``(task, nth, part)`` orders the
    segments of a conversation; ``text`` is formatted; ``state`` is the machine's
    after the turn.
    """
    template = template or ChatTemplate()
    spark = configure(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ranged = rows.repartitionByRange(width(turns), "conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")
    fixed = cut_lineage(ranged)
    ddl = "task int, first long, last long, alone boolean, leads array<string>"
    leads = fixed.mapInArrow(_leads(template), ddl).collect()  # one row per task
    entries = entry_states(leads, template.states)
    names = ["conv_id", "task", "nth", "turn", "role", "part", "text", "loss", "state"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId()
        state, conv = entries.get(number, START), None
        for nth, (now, turn, role, text) in enumerate(_rows(batches)):
            if nth and now != conv:
                state = START
            conv, state = now, template.next_state(state, role)
            for part, (said, loss) in enumerate(template.segments(role, text)):
                yield now, number, nth, turn, role, part, said, loss, state

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(segments(batches), schema)

    out = "conv_id long, task int, nth long, turn long, role string, part int, text string, loss boolean, state string"
    return spark.createDataFrame([], out) if not leads else fixed.mapInArrow(task, out)


def join_segments(segments: DataFrame) -> DataFrame:
    """``conv_id, task, nth, formatted, loss_spans, state``: segments of whole turns as pieces of bounded length.

    ``loss_spans`` are the (start, end) places of learnt text in the piece. Needs
    the segments in the partitions and order in which they were made.
    """
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("task", pa.int32()),
            ("nth", pa.int64()),
            ("formatted", pa.string()),
            ("loss_spans", pa.list_(pa.int32())),
            ("state", pa.string()),
        ]
    )

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        key, said, spans, length, last = None, [], [], 0, ""
        for conv, number, nth, part, text, loss, state in _rows(batches):
            if key and part == 0 and (conv != key[0] or length >= PIECE_CHARS):
                yield *key, "".join(said), spans, last
                key, said, spans, length = None, [], [], 0
            key = key or (conv, number, nth)
            if loss:
                spans += [length, length + len(text)]
            said.append(text)
            length, last = length + len(text), state
        if key:
            yield *key, "".join(said), spans, last

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(pieces(batches), schema)

    wanted = segments.select("conv_id", "task", "nth", "part", "text", "loss", "state")
    return wanted.mapInArrow(task, "conv_id long, task int, nth long, formatted string, loss_spans array<int>, state string")


def chat_digests(pieces: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Per conversation, read back from the formatted pieces:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid``.

    A digest of a whole conversation is sequential by its definition: the pieces
    of one pass through one task in order, one piece in memory at a time.
    """
    template = template or ChatTemplate()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        seen, conv = False, None
        for now, formatted, spans, state in _rows(batches):
            if not seen or now != conv:
                if seen:
                    yield conv, n_turns, all_turns.hexdigest(), learnt, loss.hexdigest(), chars, last in template.final
                seen, conv, n_turns, learnt, chars = True, now, 0, 0, 0
                all_turns, loss = hashlib.sha256(), hashlib.sha256()
            for role, text in template.read_turns(formatted):
                n_turns += 1
                all_turns.update(f"{role}\n{text}\n".encode())
            for start, end in zip(spans[::2], spans[1::2], strict=True):
                text = template.unescaped(formatted[start:end])
                learnt += len(text)
                loss.update(text.encode())
            chars, last = chars + len(formatted), state
        if seen:
            yield conv, n_turns, all_turns.hexdigest(), learnt, loss.hexdigest(), chars, last in template.final

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(digests(batches), schema)

    dealt = pieces.repartition(width(pieces), "conv_id").sortWithinPartitions("conv_id", "task", "nth")
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    return dealt.select("conv_id", "formatted", "loss_spans", "state").mapInArrow(task, ddl)
