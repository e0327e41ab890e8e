"""Chat formatting: a finite-state machine over roles emits text segments with loss flags from a declarative template.

Rows come sorted by conversation and turn and are worked off as a stream, so a conversation of any length needs the
memory of one turn.  Control strings inside texts are escaped with a backslash; `read_back` undoes all of it from the
segments alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import table


@dataclass(frozen=True)
class Template:
    """Headers by role, the end of a turn, roles under the loss mask, and the transitions that a valid conversation takes."""

    headers: tuple[tuple[str, str], ...] = (("system", "### System: "), ("user", "### User: "), ("assistant", "### Assistant: "), ("tool", "### Tool: "))
    #: Any other role is spelt out, escaped, between these two.
    other: tuple[str, str] = ("### Role: ", "</role>")
    end: str = "</turn>\n"
    learned: tuple[str, ...] = ("assistant",)
    #: state -> roles that may follow; "" is the start.
    follows: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("", ("system", "user")),
        ("system", ("user",)),
        ("user", ("assistant",)),
        ("assistant", ("user", "tool")),
        ("tool", ("assistant", "tool")),
    )
    #: A conversation may stop in these states.
    final: tuple[str, ...] = ("assistant",)
    #: What is escaped inside a text: the escape itself and what every control string starts with or ends a turn or role by.
    controls: tuple[str, ...] = ("\\", "### ", "</turn>", "</role>")


TEMPLATE = Template()


@dataclass
class Machine:
    """Compiled form of a template."""

    template: Template = field(default_factory=Template)

    def __post_init__(self) -> None:
        t = self.template
        self.headers, self.follows = dict(t.headers), {k: frozenset(v) for k, v in t.follows}
        self._escape = re.compile("|".join(map(re.escape, t.controls)))
        starts = [(role, text) for role, text in t.headers] + [(None, t.other[0])]
        self._header = re.compile("|".join(f"({re.escape(text)})" for _, text in starts))
        self._roles = [role for role, _ in starts]
        self._stop = re.compile(r"\\(.)|(" + re.escape(t.end) + ")|(" + re.escape(t.other[1]) + ")", re.S)

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: "\\" + m[0], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(segment, under the loss mask) of one turn."""
        header = self.headers.get(role)
        if header is None:
            header = self.template.other[0] + self.escape(role) + self.template.other[1]
        return [(header, False), (self.escape(text), role in self.template.learned), (self.template.end, False)]

    def unescape_to(self, text: str, at: int, role: bool) -> tuple[str, int]:
        """Reads escaped text up to its end mark (of a role's name or of a turn): (plain text, place after the mark)."""
        parts, begin = [], at
        for m in self._stop.finditer(text, at):
            if m[1] is not None:
                parts += (text[begin : m.start()], m[1])
            elif (m[3] if role else m[2]) is not None:
                parts.append(text[begin : m.start()])
                return "".join(parts), m.end()
            else:
                continue
            begin = m.end()
        raise ValueError("a turn without its end")

    def read(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn of formatted text."""
        at = 0
        while at < len(text):
            m = self._header.match(text, at)
            if m is None:
                raise ValueError(f"no header at {at}")
            role, at = self._roles[m.lastindex - 1], m.end()
            if role is None:
                role, at = self.unescape_to(text, at, True)
            plain, at = self.unescape_to(text, at, False)
            yield role, plain

    def unmask(self, segment: str) -> str:
        return self.unescape_to(segment + self.template.end, 0, False)[0]


Segment = tuple[int | None, int, str, bool, bool]


def emit(rows: Iterable[tuple[int | None, str | None, str | None]], machine: Machine) -> Iterator[tuple[Segment, bool]]:
    """Segments (conv_id, turn from 0, text, loss, order valid so far) of rows sorted by conversation, each with whether it ends its turn."""
    now: object = emit
    state, turn, valid = "", 0, True
    for conv, role, text in rows:
        role, text = role or "", text or ""
        if conv != now:
            now, state, turn, valid = conv, "", 0, True
        valid = valid and role in machine.follows.get(state, ())
        state = role
        parts = machine.segments(role, text)
        for i, (segment, loss) in enumerate(parts):
            yield (conv, turn, segment, loss, valid), i == len(parts) - 1
        turn += 1


class Digest:
    """What is read back of one conversation from its segments, turn by turn."""

    def __init__(self, conv: int | None, machine: Machine):
        self.conv, self.machine, self.n_turns, self.loss_chars, self.chars, self.valid, self.last = conv, machine, 0, 0, 0, True, ""
        self.turns, self.loss, self.open = hashlib.sha256(), hashlib.sha256(), []

    def add(self, segment: str, loss: bool, valid: bool, ends: bool) -> None:
        self.chars += len(segment)
        self.valid = valid
        if loss:
            plain = self.machine.unmask(segment)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.open.append(segment)
        if ends:
            for role, plain in self.machine.read("".join(self.open)):
                self.n_turns += 1
                self.last = role
                self.turns.update(f"{role}\n{plain}\n".encode())
            self.open.clear()

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid and self.last in self.machine.template.final)


def read_back(segments: Iterable[tuple[Segment, bool]], machine: Machine) -> Iterator[tuple]:
    """One digest row a conversation, from the stream of its segments."""
    now: Digest | None = None
    for (conv, _, segment, loss, valid), ends in segments:
        if now is None or conv != now.conv:
            if now is not None:
                yield now.row()
            now = Digest(conv, machine)
        now.add(segment, loss, valid, ends)
    if now is not None:
        yield now.row()


def _ordered(turns: DataFrame) -> DataFrame:
    """Each conversation in one partition, in turn order; ties go by role and text, nulls first."""
    return turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)


def _batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    weight = 0
    for row in rows:
        kept.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str))
        if len(kept) >= size or weight >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), schema.types, strict=True)], schema=schema)
            kept, weight = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), schema.types, strict=True)], schema=schema)


SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_())])
DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])


def format_chats(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Segments of all conversations in order: conv_id, turn long (from 0), segment string, loss boolean, valid boolean (turn order so far).

    `turns` has conv_id, turn, role, text; other columns are ignored.  A null text or role is an empty one; null conv_ids
    are one conversation; tied turns go by role, then text; invalid conversations are formatted too and flagged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched((s for s, _ in emit(_rows(batches), Machine(template))), SEGMENTS)

    return _ordered(turns).mapInArrow(run, "conv_id long, turn long, segment string, loss boolean, valid boolean")


def digests(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row a conversation, read back from the segments that `format_chats` emits, in the same pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(template)
        yield from _batched(read_back(emit(_rows(batches), machine), machine), DIGESTS)

    return _ordered(turns).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


PROBE = "\\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: all conversations and conversation -7."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digests(turns.unionByName(probe))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 WHEN 'tool' THEN 10 ELSE 17 + length(replace(replace(replace(replace(role, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), '</role>', '\</role>')) END
         + length(replace(replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>'), '</role>', '\</role>')) + 8 AS chars,
         coalesce(lag(role) OVER w, '') AS before, lead(role) OVER w IS NULL AS last
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       bool_and((before, role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'), ('assistant', 'tool'), ('tool', 'assistant'), ('tool', 'tool'))
                AND (NOT last OR role = 'assistant')) AS valid
FROM e GROUP BY conv_id
"""
