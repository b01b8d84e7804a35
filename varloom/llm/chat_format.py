"""Chat formatting, checked by a grammar round trip.

A formatted conversation is its turns one after the other::

    conversation = turn*
    turn         = opening text closing            (the markers name the role)
                 | opening name between text closing   (any other role)

The parser is deterministic: it reads the one marker at its place, then looks
for the next marker, which must be the one that ends this part. A turn is
rendered as it stands, parsed again and compared with its source; where they
differ (its text holds a marker, or what looks like an escape), it is escaped
and parsed again until they are identical. The parser has no state between
turns, so turns that come back one by one come back in a row.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices
from varloom.staging import staged

BATCH_BYTES = 8 << 20


class Incomplete(ValueError):
    """The text ends inside a turn."""


class NoTurn(ValueError):
    """The text is no turn of the grammar."""


@dataclass
class Template:
    """Markers of a chat format: (opening, closing) by role, and (opening, between, closing) for any other role."""

    roles: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    loss_role: str = "assistant"
    #: Markers, longest first; first characters that are escaped; escapes.
    marker: re.Pattern = field(init=False, repr=False)

    def __post_init__(self):
        marks = sorted({m for pair in self.roles.values() for m in pair} | set(self.other), key=lambda m: (-len(m), m))
        openings = [pair[0] for pair in self.roles.values()] + [self.other[0]]
        if not all(marks) or len(set(openings)) < len(openings) or any(b.startswith(a) for a in marks for b in marks if a != b):
            raise ValueError("markers must not be empty, openings must differ, and no marker may begin another one")
        self.by_opening = {pair[0]: (role, pair[1]) for role, pair in self.roles.items()}
        self.marker = re.compile("|".join(map(re.escape, marks)))
        codes = sorted({ord(m[0]) for m in marks} | {ord("&")})
        self._escape = re.compile(f"&#(?:{'|'.join(map(str, codes))});")
        self._levels = (re.compile(f"&(?=#(?:{'|'.join(map(str, codes))});)|" + "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in marks)),
                        re.compile("|".join(re.escape(chr(c)) for c in codes)))

    def escape(self, text: str, level: int) -> str:
        """0: as it is; 1: where a marker or an escape starts; 2: wherever one might."""
        return text if level == 0 else self._levels[level - 1].sub(lambda m: f"&#{ord(m.group())};", text)

    def unescape(self, text: str) -> str:
        return self._escape.sub(lambda m: chr(int(m.group()[2:-1])), text) if "&#" in text else text

    def read_turn(self, body: str, at: int = 0) -> tuple[str, int, int, int]:
        """Role, start and end of the (escaped) text, and end of the turn that begins at ``at``."""
        first = self.marker.match(body, at)
        if first is None:
            raise Incomplete if any(m.startswith(body[at:]) for m in (*self.by_opening, self.other[0])) else NoTurn
        role, closing = self.by_opening.get(first.group(), (None, self.other[2]))
        start = first.end()
        if role is None:
            if first.group() != self.other[0]:
                raise NoTurn
            between = self._next(body, start, self.other[1])
            role, start = self.unescape(body[start:between.start()]), between.end()
        end = self._next(body, start, closing)
        return role, start, end.start(), end.end()

    def _next(self, body: str, at: int, wanted: str) -> re.Match:
        found = self.marker.search(body, at)
        if found is None:
            raise Incomplete
        if found.group() != wanted:
            raise NoTurn
        return found

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """A turn that the parser reads back identically, and where its text lies in it."""
        opening, closing = self.roles.get(role, (None, self.other[2]))
        for level in range(3):
            head = opening if opening is not None else self.other[0] + self.escape(role, level) + self.other[1]
            turn = head + self.escape(text, level) + closing
            try:
                again, start, end, stop = self.read_turn(turn)
            except ValueError:
                continue
            if stop == len(turn) and again == role and self.unescape(turn[start:end]) == text:
                return turn, start, end
        raise ValueError(f"the template cannot hold this turn: {turn[:80]!r}")


#: The template of the registered query.
INSTRUCTION = Template({"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("[OUT]", "</s>")}, ("[ROLE]", "[TEXT]", "[/ROLE]"))

FORMATTED = "conv_id long, turn long, role string, formatted string, loss_start long, loss_end long"


def format_turns(conversations: DataFrame, template: Template = INSTRUCTION, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Per row: conv_id, turn, role, formatted, and the code points of it under the loss mask (null: none).

    A conversation's formatted text is that of its rows in the order of turn
    (null first), role, formatted. Nothing is exchanged. Null roles and texts
    are empty, repeated rows are turns of their own, a null conv_id stays null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            roles = batch.column("role").to_pylist()
            turns = [template.render(r, t) for r, t in zip(roles, batch.column("text").to_pylist())]
            under = [r == template.loss_role for r in roles]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array([t[0] for t in turns], pa.string()),
                 *[pa.array([t[k] if u else None for t, u in zip(turns, under)], pa.int64()) for k in (1, 2)]],
                ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end"])

    return conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).mapInArrow(run, FORMATTED)


class ConversationReader:
    """Parses the pieces of one formatted conversation as they come; keeps digests, counts and an unfinished turn."""

    def __init__(self, conv_id: int | None, template: Template):
        self.conv_id, self.template, self.rest = conv_id, template, ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def feed(self, piece: str, start: int | None, end: int | None) -> None:
        self.chars += len(piece)
        if start is not None:
            under = self.template.unescape(piece[start:end])
            self.loss.update(under.encode())
            self.loss_chars += len(under)
        body, at = self.rest + piece, 0
        while at < len(body):
            try:
                role, first, last, stop = self.template.read_turn(body, at)
            except Incomplete:
                break
            self.turns.update(f"{role}\n{self.template.unescape(body[first:last])}\n".encode())
            self.n_turns += 1
            at = stop
        self.rest = body[at:]

    def row(self) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {self.conv_id} ends inside a turn")
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ_BACK = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_conversations(formatted: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """Per conversation what the parser reads in the output of ``format_turns``: turns, digests, text under the loss mask.

    One exchange. A digest is one chain over all of a conversation, so its
    pieces pass through one task, as a sorted stream of which a turn is held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, done = None, []
        for batch in byte_slices(batches, "formatted", BATCH_BYTES):
            for conv, piece, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
                if reader is None or conv != reader.conv_id:
                    if reader is not None:
                        done.append(reader.row())
                    reader = ConversationReader(conv, template)
                reader.feed(piece, start, end)
            if len(done) > 4096:
                yield _rows(done)
                done = []
        if reader is not None:
            done.append(reader.row())
        yield _rows(done)

    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "formatted")
            .select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(run, READ_BACK))


def _rows(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], f.type) for k, f in enumerate(_READ_BACK)], schema=_READ_BACK)


def chat_report(conversations: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """Formats all rows, writes them, and returns per conversation what is read back.

    Null roles and texts are empty, null turns come first, rows that are equal
    in turn and role follow the order of their formatted text. Rows without
    conv_id are one conversation with a null id. No rows, no conversations.
    """
    return read_conversations(staged(format_turns(conversations, template)), template)


#: The conversation that the registered query adds, (turn, role, text) each.
HARD_CASE = (-7, [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")])


def _sql_escaped(column: str) -> str:
    for code in (38, 60, 91):
        column = f"replace({column}, '&#{code};', '&#38;#{code};')"
    for mark in ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[OUT]", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]"):
        column = f"replace({column}, '{mark}', '&#{ord(mark[0])};{mark[1:]}')"
    return column


CHAT_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {', '.join(f"({HARD_CASE[0]}, {t}, '{r}', '{x}')" for t, r, x in HARD_CASE[1])}) AS v(conv_id, turn, role, text)),
f AS (SELECT *, CASE role WHEN 'user' THEN '[INST]' || e || '[/INST]' WHEN 'system' THEN '<<SYS>>' || e || '<</SYS>>'
    WHEN 'assistant' THEN '[OUT]' || e || '</s>' ELSE '[ROLE]' || {_sql_escaped('role')} || '[TEXT]' || e || '[/ROLE]' END AS formatted
  FROM (SELECT *, {_sql_escaped('text')} AS e FROM c) AS x)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, formatted)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, formatted) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS bigint) AS formatted_chars
FROM f GROUP BY conv_id"""
