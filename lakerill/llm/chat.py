"""Chat formatting: a state machine over roles, and a template that says what is emitted and what counts for the loss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "conv_id long, number long, segment int, text string, loss boolean, valid boolean"
_SEGMENT_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("number", pa.int64()), ("segment", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_())]
)
_READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
    " n_invalid long"
)


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How turns are written. ``other`` writes roles without an entry: opening, what ends the role's name, closing.

    ``after`` is the state machine: which roles may follow each role ("" is the start).
    """

    turns: Mapping[str, Turn]
    other: tuple[str, str, str]
    after: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        marks = self.marks
        for c in marks:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"a mark has two characters or more, none a backslash: {c!r}")
            for m in marks:
                if any(m.startswith(c[k:]) for k in range(1, len(c))):
                    raise ValueError(f"{c!r} can end inside {m!r}")

    @cached_property
    def marks(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*(x for t in self.turns.values() for x in (t.open, t.close)), *self.other]))

    @cached_property
    def _hidden(self) -> re.Pattern:
        return re.compile("(?=" + "|".join(map(re.escape, self.marks)) + ").", re.S)

    @cached_property
    def _shape(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, sorted(self.marks, key=len, reverse=True))))

    def escape(self, text: str) -> str:
        """Double backslashes, and put one after the first character of every mark: no mark is left."""
        return self._hidden.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def write(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of a turn and whether they count for the loss."""
        if (t := self.turns.get(role)) is not None:
            return [(t.open, False), (self.escape(text), t.loss), (t.close, False)]
        start, middle, end = self.other
        return [(start + self.escape(role) + middle, False), (self.escape(text), False), (end, False)]

    def read(self, written: str) -> tuple[str, str]:
        """Role and text of one written turn."""
        first = self._shape.match(written)
        last = list(self._shape.finditer(written))[-1]
        inner = written[first.end() : last.start()]
        for role, t in self.turns.items():
            if (t.open, t.close) == (first.group(), last.group()):
                return role, self.unescape(inner)
        role, text = inner.split(self.other[1])
        return self.unescape(role), self.unescape(text)


#: A template with instruction marks; only what the assistant says counts for the loss.
INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>", "<</SYS>>"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    other=("[ROLE]", "[TEXT]", "[/ROLE]"),
    after={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)


def _format(template: Template):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number, state = object(), 0, ""
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != current:
                    current, number, state = conv, 0, ""
                valid = role in template.after.get(state, ())
                state = role if role in template.turns else state
                for k, (piece, loss) in enumerate(template.write(role, text)):
                    out.append((conv, number, k, piece, loss, valid))
                number += 1
            if out:
                cols = [pa.array(c, f.type) for c, f in zip(zip(*out), _SEGMENT_SCHEMA)]
                yield pa.RecordBatch.from_arrays(cols, schema=_SEGMENT_SCHEMA)

    return run


def format_conversations(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Segments of every turn: ``conv_id``, ``number`` (of the turn, from 0), ``segment``, ``text``, ``loss``, ``valid``.

    Turns go by ``turn`` (nulls first), then role and text; null roles and texts are empty. A turn that the state machine
    does not expect is written all the same, with ``valid`` false; so is an unknown role, by the template's general form.
    Rows stream through their task in order, so a conversation of any length needs the memory of one batch; it does stay in one
    task, since the order of its turns decides. Rows without conv_id form one conversation.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format(template), SEGMENTS)


def _read(template: Template):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_invalid", pa.int64())]
        )
        current, number, total, written, one = None, None, None, [], None
        done: list[tuple] = []

        def end_turn() -> None:
            if written:
                role, text = template.read("".join(p for p, _ in written))
                total["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                total["n"] += 1
                total["invalid"] += not one
                for piece, loss in written:
                    total["chars"] += len(piece)
                    if loss:
                        said = template.unescape(piece)
                        total["loss"].update(said.encode("utf-8", "surrogatepass"))
                        total["said"] += len(said)
                written.clear()

        def end() -> None:
            end_turn()
            if total:
                t = total
                done.append((current, t["n"], t["turns"].hexdigest(), t["said"], t["loss"].hexdigest(), t["chars"], t["invalid"]))

        for batch in batches:
            done = []
            for conv, n, text, loss, valid in zip(*(batch[c].to_pylist() for c in ("conv_id", "number", "text", "loss", "valid"))):
                if total is None or conv != current:
                    end()
                    total = {"turns": hashlib.sha256(), "loss": hashlib.sha256(), "n": 0, "said": 0, "chars": 0, "invalid": 0}
                    current, number = conv, n
                elif n != number:
                    end_turn()
                number, one = n, valid
                written.append((text, loss))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        done = []
        end()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    return run


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation what its segments say: turns, digests of turns and of all text under the loss, lengths.

    The digests run over a conversation in order, turn by turn in constant memory.
    """
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "number", "segment")
    return ordered.mapInArrow(_read(template), _READ)
