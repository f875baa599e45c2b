"""Chat formatting: a finite-state machine over roles emits text segments with loss flags from a declarative template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around the turns of each role, the roles that carry loss, and the order of roles.

    ``marks``: role to (before, after). A role without marks is written as ``other[0] + role + other[1] + text +
    other[2]``. ``order``: state to {role: next state}; a turn that has no arc makes the conversation invalid and leads
    to the role's own state. Mark strings must not hold a backslash, and none may begin with what another (or itself) ends in: a
    text behind it could then complete a mark. Roles differ in the mark before their turns.
    """

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("<|role|>", "<|text|>", "<|end|>")
    loss: frozenset[str] = frozenset({"assistant"})
    order: dict[str, dict[str, str]] = field(default_factory=lambda: {"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user"}})
    ends: frozenset[str] = frozenset({"assistant"})

    @property
    def controls(self) -> list[str]:
        return sorted({c for pair in self.marks.values() for c in pair} | set(self.other), key=lambda c: (-len(c), c))


class Escaper:
    """Reversible escapes: no control string is left in a text, nor the start of one at its end.

    A backslash becomes two; after the first character of each place where a control string begins (places that
    overlap included), and of each unfinished one at the end, backslash-dot is inserted.
    """

    def __init__(self, controls: list[str]) -> None:
        if any("\\" in c or len(c) < 2 for c in controls):
            raise ValueError("control strings have two characters or more and no backslash")
        if any(a[-k:] == b[:k] for a in controls for b in controls for k in range(1, min(len(a), len(b)) + 1) if (a, k) != (b, len(b))):
            raise ValueError("no control string may begin with what another, or itself, ends in")
        whole = "|".join(re.escape(c) for c in controls)
        begun = "|".join(sorted({re.escape(c[:k]) + r"\Z" for c in controls for k in range(1, len(c))}))
        self.starts = re.compile(f"(?=({whole}|{begun}))(.)", re.S)
        self.plain = re.compile("|".join(sorted({re.escape(c[0]) for c in controls} | {r"\\"})))

    def escape(self, text: str) -> str:
        if not self.plain.search(text):
            return text
        return self.starts.sub(r"\2\\.", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\([\\.])", lambda m: "\\" if m[1] == "\\" else "", text) if "\\" in text else text


@dataclass(frozen=True)
class Segment:
    text: str
    loss: bool


class Formatter:
    """Walks the turns of one conversation."""

    def __init__(self, template: Template) -> None:
        self.template, self.escaper = template, Escaper(template.controls)
        self.state, self.valid = "start", True
        opens = [before for before, _ in template.marks.values()]
        if len({*opens, template.other[0]}) <= len(opens):
            raise ValueError("roles must differ in the mark before their turns")

    def turn(self, role: str, text: str) -> Iterator[Segment]:
        arcs = self.template.order.get(self.state, {})
        self.valid &= role in arcs
        self.state = arcs.get(role, role)
        body = self.escaper.escape(text)
        if (marks := self.template.marks.get(role)) is not None:
            before, after = marks
        else:
            before, after = self.template.other[0] + self.escaper.escape(role) + self.template.other[1], self.template.other[2]
        yield Segment(before, False)
        yield Segment(body, role in self.template.loss)
        yield Segment(after, False)

    def done(self) -> bool:
        """Whether all turns were in order and the last may end a conversation."""
        return self.valid and self.state in self.template.ends


class Reader:
    """Reads turns back from the segments of one conversation: from their characters and loss flags alone.

    Characters are held until the control string that ends a turn has come, so a turn is the most that is in memory.
    """

    def __init__(self, template: Template) -> None:
        self.template = template
        self.controls = re.compile("|".join(re.escape(c) for c in template.controls))
        self.opens = {before: (role, after) for role, (before, after) in template.marks.items()}
        self.held = ""
        self.turns, self.loss, self.chars = hashlib.sha256(), hashlib.sha256(), 0
        self.n_turns = self.loss_chars = 0
        self.bad = False

    def feed(self, segments: Iterable[Segment]) -> None:
        for s in segments:
            self.chars += len(s.text)
            if s.loss:
                said = Escaper.unescape(s.text)
                self.loss_chars += len(said)
                self.loss.update(said.encode())
            self.held += s.text
            if not s.loss and s.text:
                self._parse()

    def _parse(self) -> None:
        """Take the turns that are complete in what is held."""
        at = 0
        while (first := self.controls.search(self.held, at)) is not None:
            role_mark, text_mark, end_mark = self.template.other
            begin = first.end()
            if first.start() != at:
                self.bad = True
            if first[0] == role_mark:
                second = self.controls.search(self.held, begin)
                if second is None:
                    break
                role, begin = Escaper.unescape(self.held[begin : second.start()]), second.end()
                self.bad |= second[0] != text_mark
                due = end_mark
            elif first[0] in self.opens:
                role, due = self.opens[first[0]]
            else:
                self.bad = True
                at = begin
                continue
            last = self.controls.search(self.held, begin)
            if last is None:
                break
            self.bad |= last[0] != due
            text = Escaper.unescape(self.held[begin : last.start()])
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
            at = last.end()
        self.held = self.held[at:]

    def row(self) -> dict:
        if self.held or self.bad:
            raise ValueError("formatted text does not read back")
        return {"n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


SEGMENTS = "conv_id long, segment long, text string, loss boolean, valid boolean"


def format_conversations(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """``conv_id, segment, text, loss, valid``: the segments of each conversation, in order within a partition.

    Turns go by number (null first; equal numbers by role, then text); null roles and texts are empty. All
    conversations are formatted; ``valid`` (on the last segment, null before) tells whether the roles came in order. A
    null conv_id is one conversation. Repeated rows are turns of their own. An empty table gives no rows. A conversation
    is a stream through one task: of even a very long one, a batch is in memory at a time.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, machine, n = object(), None, 0
        for batch in batches:
            out: list[tuple] = []
            convs, starts, ends, roles, texts = (batch.column(k).to_pylist() for k in range(5))
            for c, start, end, role, text in zip(convs, starts, ends, roles, texts):
                if start:
                    conv, machine, n = c, Formatter(template), 0
                for s in machine.turn(role or "", text or ""):
                    out.append((conv, n, s.text, s.loss, None))
                    n += 1
                if end:
                    out[-1] = (*out[-1][:4], machine.done())
            columns = zip(*out) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds)], names=["conv_id", "segment", "text", "loss", "valid"])

    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return _bounded(rows, ["turn", "role", "text"], ["role", "text"], partitions).mapInArrow(run, SEGMENTS)


def _bounded(rows: DataFrame, order: list[str], carry: list[str], partitions: int | None) -> DataFrame:
    """``conv_id, starts, ends, *carry``: sorted by conversation, its first and last row marked."""
    from pyspark.sql import Window as W

    if partitions:
        rows = rows.repartition(partitions, "conv_id")
    w = W.partitionBy("conv_id").orderBy(*order)
    place = F.row_number().over(w)
    later = F.lead(F.lit(1)).over(w)
    return rows.withColumns({"__at": place, "__later": later}).select("conv_id", (F.col("__at") == 1).alias("starts"), F.col("__later").isNull().alias("ends"), *carry)


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid`` from formatted segments.

    ``segments`` is what ``format_conversations`` returns (each conversation's segments in order in one partition).
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: Reader | None = None
        for batch in batches:
            out = []
            for conv, number, text, loss, valid in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if number == 0:
                    reader = Reader(template)
                reader.feed([Segment(text, loss)])
                if valid is not None:
                    out.append({"conv_id": conv, **reader.row(), "valid": valid})
            kinds = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())]
            yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    return segments.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")
