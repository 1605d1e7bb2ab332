"""Chats as text: a finite-state machine over roles, segments with loss flags, from a declared template.

Turns of a conversation are dealt to one task in order and streamed through it: the task holds
one turn at a time, however long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.common import importable

SEGMENTS = "conv_id long, turn_no long, role_ok boolean, part string, loss boolean, text string"


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles are learned, and which may follow which.

    Control strings begin with ``mark``. Inside texts and roles ``mark`` and the escape character
    are escaped, and in roles line ends too, so that a formatted text can be read back.
    """

    mark: str = "<|"
    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    learned: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {
        "": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"}),
    })

    def escape(self, text: str) -> str:
        return text.replace("\\", "\\\\").replace(self.mark, self.mark[0] + "\\." + self.mark[1:])

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", lambda m: {".": "", "n": "\n"}.get(m[1], m[1]), text, flags=re.S)

    def segments(self, role: str, text: str) -> list[tuple[str, bool, str]]:
        role_text = self.escape(role).replace("\n", "\\n")
        return [("open", False, self.opening + role_text + self.after_role), ("body", role in self.learned, self.escape(text)), ("close", False, self.closing)]

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of a formatted text; ValueError if it isn't one."""
        turn = re.compile(re.escape(self.opening) + "(.*?)" + re.escape(self.after_role) + "(.*?)" + re.escape(self.closing), re.S)
        turns, at = [], 0
        while at < len(formatted):
            if not (m := turn.match(formatted, at)):
                raise ValueError(f"no turn at {at}")
            turns.append((self.unescape(m[1]), self.unescape(m[2])))
            at = m.end()
        return turns


def ordered(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together, by turn; ties by role and text, nulls first."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """SEGMENTS in order: joined, a conversation's ``text`` is its formatted text.

    Null roles and texts are empty; turns without conv_id make one conversation. ``role_ok`` says
    whether the turn's role may follow the one before. Nothing is left out: a conversation that
    breaks the order is formatted as well.
    """
    importable(conversations.sparkSession)
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.bool_(), pa.string()]
    names = [c.split()[0] for c in SEGMENTS.split(", ")]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, number = object(), "", 0
        for batch in batches:
            rows = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if c != conv:
                    conv, state, number = c, "", 0
                ok = role in template.follows.get(state, ())
                rows += [(c, number, ok, *s) for s in template.segments(role, text)]
                state, number = role, number + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    return ordered(conversations).mapInArrow(work, SEGMENTS)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """What formatted conversations say, parsed again; segments as ``format_turns`` has them dealt and ordered."""
    importable(segments.sparkSession)
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, one = object(), None

        def begin(c):
            return {"conv_id": c, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "formatted_chars": 0, "valid": True, "last": "", "held": []}

        def end(x):
            return {"conv_id": x["conv_id"], "n_turns": x["n_turns"], "turns_sha256": x["turns"].hexdigest(), "loss_chars": x["loss_chars"], "loss_sha256": x["loss"].hexdigest(), "formatted_chars": x["formatted_chars"], "valid": x["valid"] and x["last"] == "assistant"}

        for batch in batches:
            rows = []
            for c, ok, part, loss, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                if c != conv:
                    if one:
                        rows.append(end(one))
                    conv, one = c, begin(c)
                one["held"].append(text)
                one["formatted_chars"] += len(text)
                one["valid"] &= ok
                if loss:
                    learned = template.unescape(text)
                    one["loss"].update(learned.encode())
                    one["loss_chars"] += len(learned)
                if part == "close":
                    for role, said in template.parse("".join(one["held"])):
                        one["turns"].update(f"{role}\n{said}\n".encode())
                        one["n_turns"] += 1
                        one["last"] = role
                    one["held"] = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=out)
        if one:
            yield pa.RecordBatch.from_pylist([end(one)], schema=out)

    return segments.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")
