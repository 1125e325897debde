"""Chat formatting with templates that are only called, never read.

A template is a function from a list of messages to a string. Successive prefixes of a conversation are rendered and
each output is compared with the one before: what was added is the span of the new turn, and an output that does not
begin with the one before shows a template that rewrites history. Where a turn's text lies inside its span is found by
rendering the turn once more with a marker in place of the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papertrove.llm.words import table

Message = dict[str, str]
Template = Callable[[list[Message]], str]

#: Marks of the bundled template: what stands before and after a turn's text.
MARKS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[ROLE:", "] ", " [/ROLE]")
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ANS]", "[SYS]", "[/SYS]", "[ROLE:", "[/ROLE]")
_CONTROL = re.compile("|".join(re.escape(control) for control in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]|\[ANS\] (?P<assistant>.*?) </s>|\[SYS\] (?P<system>.*?) \[/SYS\]"
    r"|\[ROLE:(?P<role>(?:[^\\\]]|\\.)*)\] (?P<other>.*?) \[/ROLE\]",
    re.DOTALL,
)
_MARKER = "marker"


class HistoryRewritten(ValueError):
    """The output for a longer prefix does not begin with the output for a shorter one."""


@dataclass(frozen=True)
class Turn:
    """A turn's place in the output, in code points: its span, and its text's span inside that."""

    role: str
    start: int
    text_start: int
    text_end: int
    end: int


def escaped(text: str) -> str:
    """The text with a backslash after the first character of every control string, and backslashes doubled."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def bundled_template(messages: list[Message]) -> str:
    """Every turn between the marks of its role; control strings inside texts are escaped."""
    out = []
    for message in messages:
        if message["role"] in MARKS:
            before, after = MARKS[message["role"]]
        else:
            name = escaped(message["role"]).replace("]", "\\]")
            before, after = f"{OTHER[0]}{name}{OTHER[1]}", OTHER[2]
        out += [before, escaped(message["text"]), after]
    return "".join(out)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from an output of the bundled template."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        role = unescaped(m["role"]) if kind == "other" else kind
        turns.append((role, unescaped(m[kind])))
        at = m.end()
    return turns


def render_turns(messages: list[Message], template: Template = bundled_template) -> tuple[str, list[Turn]]:
    """The formatted conversation and the place of every turn.

    Every prefix is rendered in full and must begin with the output before it: ``HistoryRewritten`` is raised for a
    template whose output for any prefix changes when a turn follows, at whatever turn. A template is only called, so
    nothing less would show this, and the work grows with the square of a conversation's turns.
    """
    output, turns = "", []
    for index, message in enumerate(messages):
        known, before = messages[:index], output
        output = template([*known, message])
        if not output.startswith(before):
            raise HistoryRewritten(f"turn {index} changes what was rendered before it")
        low, high = _text_place(template, known, message, before, output[len(before) :])
        turns.append(Turn(message["role"], len(before), len(before) + low, len(before) + high, len(output)))
    return output, turns


def _text_place(template: Template, known: list[Message], message: Message, before: str, piece: str) -> tuple[int, int]:
    """Start and end of the text inside the piece that its turn added; the whole piece if the template changes texts."""
    marked = template([*known, message | {"text": _MARKER}])[len(before) :]
    head, found, tail = marked.partition(_MARKER)
    if found and len(piece) >= len(head) + len(tail) and piece.startswith(head) and piece.endswith(tail):
        return len(head), len(piece) - len(tail)
    return 0, len(piece)


_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("formatted", pa.string()),
        ("loss_spans", pa.list_(pa.int64())),
    ]
)


def format_conversations(
    conversations: DataFrame, template: Template = bundled_template, learned: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """One row per ``conv_id`` of ``conversations`` (``conv_id, turn, role, text``; others do not matter).

    ``formatted`` is the template's output and ``loss_spans`` the start and end of every learned text in it (code points,
    flat). The digests are read back from that output: roles and texts by the template's marks, the loss text by the
    spans. Turns are ordered by ``turn`` (null first), then role and text, so repeated rows are repeated turns. A null
    role or text counts as empty; rows with a null ``conv_id`` form one conversation. Conversations are read one after
    the other from sorted partitions, and only one is held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Message] = []
        current = None
        out: dict[str, list] = {name: [] for name in _FORMATTED.names}
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != current:
                    _add(out, current, held, template, learned)
                    held = []
                    if len(out["conv_id"]) >= 256:
                        yield table(_FORMATTED, **out)
                        out = {name: [] for name in _FORMATTED.names}
                current = row["conv_id"]
                held.append({"role": row["role"], "text": row["text"]})
        if held:
            _add(out, current, held, template, learned)
        yield table(_FORMATTED, **out)

    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "formatted string, loss_spans array<long>",
    )


def _add(out: dict, conv_id: int | None, messages: list[Message], template: Template, learned: tuple[str, ...]) -> None:
    formatted, turns = render_turns(messages, template)
    read = read_turns(formatted) if template is bundled_template else [(m["role"], m["text"]) for m in messages]
    spans = [(turn.text_start, turn.text_end) for turn in turns if turn.role in learned]
    loss = "".join(unescaped(formatted[start:end]) for start, end in spans)
    values = {
        "conv_id": conv_id,
        "n_turns": len(read),
        "turns_sha256": _sha256("".join(f"{role}\n{text}\n" for role, text in read)),
        "loss_chars": len(loss),
        "loss_sha256": _sha256(loss),
        "formatted_chars": len(formatted),
        "formatted": formatted,
        "loss_spans": [edge for span in spans for edge in span],
    }
    for name, value in values.items():
        out[name].append(value)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
