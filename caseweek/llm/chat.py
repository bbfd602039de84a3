r"""Chat formatting by a finite-state machine over roles (operator 13).

A declarative template names the control strings around a turn, the roles whose texts are learned, and the
machine: which role may follow in which state. Every turn gives segments of text with a loss flag: the
opening with the role (no loss), the turn's text (loss if the role is learned), the closing (no loss).
Segments of a conversation are joined, and the learned ones kept as spans of code points.

Control strings inside texts are escaped by one more backslash after their first character
(``</turn>`` becomes ``<\/turn>``, ``<\/turn>`` becomes ``<\\/turn>``), so that reading back takes one away:
other text, with backslashes or without, stays as it is. In role names ``>`` and backslashes are escaped.

Turns are dealt out by (conversation, turn) ranges and sorted, so a conversation that holds a third of all
turns spreads over many tasks. A task gives whole conversations whole. One that it may share with
its neighbours, or that is longer than ``piece_chars``, is given in pieces; for each the machine's
outcome is kept for every state it may be entered in, so that pieces are judged in parallel and put
together in order. ``digests`` hashes them in order; only hashing a conversation is one task's work.

Defined results: a null text counts as empty; a null role has no name and is read back as null; null
conversation ids are one conversation, null turns come first; turns of equal number are ordered by role and
the hash of their text (repeated rows stay); roles that the machine doesn't know, or not there, are violations, counted and
formatted all the same; an empty table gives no rows; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Formatted characters after which a conversation is cut into another piece, between turns, and rows handled at
#: a time. Both bound memory only.
PIECE = 1 << 18
ROWS = 1024


@dataclass(frozen=True)
class Template:
    """Control strings, learned roles and turn order. ``moves`` gives the roles allowed in each state; the state
    after a turn has the role's name. Conversations should end in a state of ``finals``."""
    opening: str = "<turn:"
    named: str = ">"
    closing: str = "</turn>"
    after: str = "\n"
    learned: frozenset[str] = frozenset({"assistant"})
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    finals: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self):
        for control in (self.opening, self.closing):
            if len(control) < 2 or "\\" in control or control[0] in control[1:]:
                raise ValueError(f"control string {control!r} needs two characters, the first only once, no backslash")
        if "start" not in self.moves or self.named != self.named.strip("\\") or len(self.named) != 1:
            raise ValueError("the machine needs a state start, and role names one character to end them")

    @property
    def states(self) -> list[str]:
        return list(self.moves)


class Formatter:
    """Turns to segments and back, by one template."""

    def __init__(self, template: Template):
        self.template = template
        heads = sorted({template.opening[0], template.closing[0]})
        rests = "|".join(re.escape(c[1:]) for c in (template.opening, template.closing))
        first = "[" + re.escape("".join(heads)) + "]"
        self._plain = re.compile(rf"({first})(\\*)(?={rests})")
        self._escaped = re.compile(rf"({first})\\(\\*)(?={rests})")
        self.states = template.states
        self._state = {name: k for k, name in enumerate(self.states)}

    def escape(self, text: str) -> str:
        return self._plain.sub(r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1\2", text) if "\\" in text else text

    def name(self, role: str | None) -> str:
        return "\\0" if role is None else role.replace("\\", "\\\\").replace(self.template.named, "\\g")

    def role(self, name: str) -> str | None:
        if name == "\\0":
            return None
        return re.sub(r"\\(.)", lambda m: self.template.named if m[1] == "g" else m[1], name, flags=re.S)

    def segments(self, role: str | None, text: str | None) -> list[tuple[str, bool]]:
        """(text, loss) of a turn."""
        t = self.template
        return [(t.opening + self.name(role) + t.named, False), (self.escape(text or ""), role in t.learned),
                (t.closing + t.after, False)]

    def turns(self, formatted: str) -> Iterator[tuple[str | None, str, int, int]]:
        """(role, text, start, end) of each turn of a formatted text, read back; places are those of its text."""
        t, at = self.template, 0
        while at < len(formatted):
            start = formatted.index(t.named, at + len(t.opening)) + len(t.named)
            end = formatted.index(t.closing, start)
            role = self.role(formatted[at + len(t.opening):start - len(t.named)])
            yield role, self.unescape(formatted[start:end]), start, end
            at = end + len(t.closing) + len(t.after)

    def step(self, state: int, role: str | None) -> tuple[int, int]:
        """(next state, 1 if the role isn't allowed here). A role that no state is named after leaves the state."""
        allowed = role in self.template.moves[self.states[state]]
        return self._state.get(role, state), 0 if allowed else 1


class _Piece:
    """Turns of one conversation put together."""

    def __init__(self, formatter: Formatter):
        self.formatter, self.parts, self.spans, self.size, self.turns = formatter, [], [], 0, 0
        self.outcome = [(s, 0) for s in range(len(formatter.states))]   # by the state it is entered in

    def add(self, role: str | None, text: str | None) -> None:
        for segment, loss in self.formatter.segments(role, text):
            if loss and segment:
                self.spans.append({"start": self.size, "end": self.size + len(segment)})
            self.parts.append(segment)
            self.size += len(segment)
        self.turns += 1
        steps = {s: self.formatter.step(s, role) for s in {s for s, _ in self.outcome}}
        self.outcome = [(steps[s][0], n + steps[s][1]) for s, n in self.outcome]


_PIECE_SCHEMA = ("piece long, whole boolean, n_turns long, text string, loss array<struct<start:long,end:long>>, "
                 "ends array<int>, violations array<long>")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_conversations(turns: DataFrame, template: Template = Template(), conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         piece_chars: int = PIECE) -> DataFrame:
    """(conv, piece, whole, n_turns, text, loss, ends, violations) of every conversation.

    ``text`` is the formatted text, ``loss`` its learned spans. A conversation with ``whole`` has one piece; the
    pieces of another are its text in the order of ``piece``. ``ends`` and ``violations`` give the machine's
    state after the piece and the turns out of order in it, by the state the piece is entered in (the order of
    ``template.moves``; a conversation is entered in ``start``).
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter, number = Formatter(template), TaskContext.get().partitionId() << 40
        none = object()
        conv, piece, cut, first, done, held = none, None, False, True, [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.string(), _SPANS, pa.list_(pa.int32()), pa.list_(pa.int64()))
            arrays = [pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]
            return pa.record_batch([pa.array(columns[0], ids), *arrays],
                                   names=["conv", "piece", "whole", "n_turns", "text", "loss", "ends", "violations"])

        def close(whole: bool) -> None:
            nonlocal number, held
            done.append((conv, number, whole, piece.turns, "".join(piece.parts), piece.spans,
                         [s for s, _ in piece.outcome], [n for _, n in piece.outcome]))
            number, held = number + 1, held + piece.size

        ids = None
        for batch in batches:
            ids = batch.schema.field(0).type
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                for c, role, text in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    if c != conv or conv is none:
                        if piece is not None:
                            close(whole=not (first or cut))    # neither the task's first nor cut before
                            first = False
                        conv, piece, cut = c, _Piece(formatter), False
                    elif piece.size >= piece_chars:
                        close(whole=False)
                        piece, cut = _Piece(formatter), True
                    piece.add(role, text)
                    if held >= 4 * piece_chars:
                        yield flush()
                        done, held = [], 0
        if piece is not None:
            close(whole=False)                                 # the next task may go on with it
        if done:
            yield flush()

    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                        F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"))
    order = ("conv", "turn", "role", F.xxhash64("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "role", "text")
    made = dealt.mapInArrow(pieces, f"conv {rows.dtypes[0][1]}, {_PIECE_SCHEMA}")
    return made.withColumnRenamed("conv", conv_col)


def read_turns(formatted: str, loss: Iterable, formatter: Formatter) -> list[tuple[str | None, str, bool]]:
    """(role, text, learned) of each turn of a formatted text with its learned spans."""
    spans = {(s["start"], s["end"]) for s in loss}
    return [(role, text, (start, end) in spans) for role, text, start, end in formatter.turns(formatted)]


class _Digest:
    """A conversation's figures, hashed turn by turn."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, body: bytes, learned: bytes, turns: int, loss_chars: int, chars: int) -> None:
        self.all.update(body)
        self.loss.update(learned)
        self.turns, self.loss_chars, self.chars = self.turns + turns, self.loss_chars + loss_chars, self.chars + chars


def _body(formatted: str, loss: Iterable, formatter: Formatter) -> tuple[bytes, bytes, int]:
    """(role, line end, text, line end of each turn; learned texts; their code points), read back."""
    body, learned = [], []
    for role, text, own in read_turns(formatted, loss, formatter):
        body += [role or "", "\n", text, "\n"]
        if own:
            learned.append(text)
    loss_text = "".join(learned)
    return "".join(body).encode("utf-8", "surrogatepass"), loss_text.encode("utf-8", "surrogatepass"), len(loss_text)


def digests(pieces: DataFrame, template: Template = Template(), conv_col: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, violations, complete) of every
    conversation, read back from its formatted pieces.

    Pieces are read back where they are. Of a whole conversation only its figures leave the task; the others'
    texts go, packed, to the task that hashes them in order.
    """
    schema = ("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
              "violations long, complete boolean")

    def figures(d: _Digest, state: int, violations: int, formatter: Formatter) -> tuple:
        return (d.turns, d.all.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars, violations,
                formatter.states[state] in formatter.template.finals)

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "violations", "complete"]
    start = template.states.index("start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(i, 64).to_pylist():
                    body, learned, loss_chars = _body(row["text"], row["loss"], formatter)
                    digest, packed = _Digest(), (None, None)
                    digest.add(body, learned, row["n_turns"], loss_chars, len(row["text"]))
                    if not row["whole"]:
                        packed = zlib.compress(body, 1), zlib.compress(learned, 1)
                    out.append((row["conv"], row["piece"], row["ends"], row["violations"], *packed,
                                *figures(digest, row["ends"][start], row["violations"][start], formatter)))
                columns = list(zip(*out, strict=True))
                types = (batch.schema.field(0).type, pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()),
                         pa.binary(), pa.binary(), *kinds)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=["conv", "piece", "ends", "faults", "body", "learned", *names])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template)
        open_conv, digest, state, faults = None, None, start, 0
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(i, 64).to_pylist():
                    if digest is not None and (row["body"] is None or row["conv"] != open_conv):
                        out.append((open_conv, *figures(digest, state, faults, formatter)))
                        digest = None
                    if row["body"] is None:
                        out.append((row["conv"], *(row[n] for n in names)))
                        continue
                    if digest is None:
                        open_conv, digest, state, faults = row["conv"], _Digest(), start, 0
                    digest.add(zlib.decompress(row["body"]), zlib.decompress(row["learned"]), row["n_turns"],
                               row["loss_chars"], row["formatted_chars"])
                    state, faults = row["ends"][state], faults + row["faults"][state]
                kind = batch.schema.field(0).type
                if out:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (kind, *kinds), strict=True)],
                                          names=["conv", *names])
        if digest is not None:
            out = [(open_conv, *figures(digest, state, faults, formatter))]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (kind, *kinds), strict=True)],
                                  names=["conv", *names])

    rows = pieces.select(F.col(f"`{conv_col}`").alias("conv"), "piece", "whole", "n_turns", "text", "loss", "ends", "violations")
    conv = rows.dtypes[0][1]
    read_back = rows.mapInArrow(read, f"conv {conv}, piece long, ends array<int>, faults array<long>, body binary, "
                                      f"learned binary, {schema}")
    dealt = read_back.repartition("conv").sortWithinPartitions("conv", "piece")
    return dealt.mapInArrow(joined, f"conv {conv}, {schema}").withColumnRenamed("conv", conv_col)
