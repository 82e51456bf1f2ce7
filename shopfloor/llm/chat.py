"""Conversations as training text, by a finite-state machine over roles.

The turns of a conversation are read in order, one after the other; the machine says whether a role may
follow. Every turn becomes text segments, each with a flag that says whether the loss counts there. A
declarative ``Template`` gives the markers, the machine and the roles under the loss.

Rows reach a task sorted by conversation and turn and are worked on as a stream, so a conversation of
any length needs no more memory than its longest turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.ship import mapped

#: Turns that a task turns into Python strings at a time.
ROWS_AT_ONCE = 512


@dataclass(frozen=True)
class Template:
    """Markers around a turn, and what may follow what.

    ``follows`` maps a state to the roles that may come next; a role is also the state after it.
    Markers start with ``<|``, which texts can't contain once they are escaped.
    """

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    start: str = "start"
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    final: tuple[str, ...] = ("assistant",)
    loss_roles: tuple[str, ...] = ("assistant",)


def escape(text: str) -> str:
    """One more backslash in every ``<|``, ``<\\|``, ``<\\\\|`` and so on."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


SEGMENT_COLUMNS = "segment long, turn long, part string, text string, loss boolean, problem string"


def _arranged(rows: DataFrame, *order: str) -> DataFrame:
    """Whole conversations in a task, in order."""
    return rows.repartition("_conv").sortWithinPartitions("_conv", *order)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield from batch.slice(at, ROWS_AT_ONCE).to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches, so that few of them are held at a time."""
    held: list[tuple] = []

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= ROWS_AT_ONCE:
            yield made()
            held = []
    if held:
        yield made()


def segments(turns: DataFrame, template: Template | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Segments of all conversations: the id, ``segment`` and ``turn`` (both from 0), ``part`` (open, text or close), ``text``, ``loss`` and ``problem``.

    Segments joined in order are the formatted conversation. ``problem`` tells, on a turn's first segment,
    why the machine rejects the turn, and on the last one that the conversation ends too early; such
    conversations are formatted all the same. Null roles and texts count as empty. Null turns come first;
    turns of the same number are ordered by role and text. Rows with a null id form one conversation.
    """
    template = template or Template()
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("_conv"),
        F.col(f"`{turn}`").alias("_turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("_role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    id_type = rows.schema["_conv"].dataType

    def walk(batches: Iterator[pa.RecordBatch], id_arrow) -> Iterator[tuple]:
        here, state, n, pending = object(), template.start, 0, None
        for row in _records(batches):
            if pending is not None and row["_conv"] == here:
                yield pending
            elif pending is not None:
                yield ended(pending, state)
            if row["_conv"] != here:
                here, state, n = row["_conv"], template.start, 0
            said = row["_role"]
            problem = None if said in template.follows.get(state, ()) else f"{said} after {state}"
            yield (here, 3 * n, n, "open", template.open + escape_role(said) + template.after_role, False, problem)
            yield (here, 3 * n + 1, n, "text", escape(row["_text"]), said in template.loss_roles, None)
            pending = (here, 3 * n + 2, n, "close", template.close, False, None)
            state, n = said, n + 1
        if pending is not None:
            yield ended(pending, state)

    def ended(row: tuple, state: str) -> tuple:
        return row if state in template.final else (*row[:-1], f"ends after {state}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        own = to_arrow_type(id_type)
        names = [("_conv", own), ("segment", pa.int64()), ("turn", pa.int64()), ("part", pa.string()), ("text", pa.string()), ("loss", pa.bool_()), ("problem", pa.string())]
        yield from _batches(walk(batches, own), pa.schema(names))

    made = mapped(_arranged(rows, "_turn", "_role", "_text"), run, f"_conv {id_type.simpleString()}, {SEGMENT_COLUMNS}")
    return made.withColumnRenamed("_conv", conv_id)


def read_back(formatted: DataFrame, template: Template | None = None, conv_id: str = "conv_id") -> DataFrame:
    """What the joined segments say: for each conversation ``n_turns``, ``turns_sha256`` (of role, newline, text, newline per turn), ``loss_chars`` and ``loss_sha256`` (of the unescaped text under the loss), ``formatted_chars`` and ``n_problems``.

    Turns are found by the markers in the text alone. Fails on text that the template can't have made.
    """
    template = template or Template()
    rows = formatted.withColumnRenamed(conv_id, "_conv").select("_conv", "segment", "text", "loss", "problem")
    id_type = rows.schema["_conv"].dataType

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        here, open_ = object(), None
        for row in _records(batches):
            if open_ is None or row["_conv"] != here:
                if open_ is not None:
                    yield closed(here, open_)
                here, open_ = row["_conv"], {"rest": "", "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "problems": 0}
            open_["chars"] += len(row["text"])
            open_["problems"] += row["problem"] is not None
            if row["loss"]:
                plain = unescape(row["text"])
                open_["loss_chars"] += len(plain)
                open_["loss"].update(plain.encode("utf-8", "surrogatepass"))
            open_["rest"] += row["text"]
            while (end := open_["rest"].find(template.close)) >= 0:
                turn, open_["rest"] = open_["rest"][:end], open_["rest"][end + len(template.close) :]
                role, mark, text = turn.removeprefix(template.open).partition(template.after_role)
                if not turn.startswith(template.open) or not mark:
                    raise ValueError(f"conversation {here}: no turn begins at {turn[:40]!r}")
                open_["turns"] += 1
                open_["all"].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
        if open_ is not None:
            yield closed(here, open_)

    def closed(here, found: dict) -> tuple:
        if found["rest"]:
            raise ValueError(f"conversation {here}: text after the last turn: {found['rest'][:40]!r}")
        return (here, found["turns"], found["all"].hexdigest(), found["loss_chars"], found["loss"].hexdigest(), found["chars"], found["problems"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        numbers = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_problems", pa.int64())]
        yield from _batches(parsed(batches), pa.schema([("_conv", to_arrow_type(id_type)), *numbers]))

    schema = f"_conv {id_type.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_problems long"
    return mapped(_arranged(rows, "segment"), run, schema).withColumnRenamed("_conv", conv_id)
