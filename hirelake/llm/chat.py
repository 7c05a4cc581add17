"""Conversations as training texts, with the mask of what a model learns.

The format marks each turn by control strings. Where one stands inside a text,
a backslash is put behind its first character (one more, if there are some), so
texts can neither open nor close a turn and are read back exactly.
"""

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.templates import Template

CONTROLS = ("[INST]", "[/INST]", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]")

TEMPLATE = """
{%- for m in messages -%}
  {%- if m.role == 'user' -%}
    {{ '[INST] ' ~ (m.text | guard) ~ ' [/INST]' }}
  {%- elif m.role == 'assistant' -%}
    {%- generation -%}{{ m.text | guard }}{%- endgeneration -%}{{ '</s>' }}
  {%- else -%}
    {{ '[ROLE]' ~ (m.role | guard) ~ '[TEXT]' ~ (m.text | guard) ~ '[/ROLE]' }}
  {%- endif -%}
{%- endfor -%}
"""


class Guard:
    """Reversible escaping of control strings. The first character of a control
    string may stand nowhere else in any of them."""

    def __init__(self, controls: Sequence[str] = CONTROLS):
        if any(len(c) < 2 or any(d[0] in c[1:] or "\\" in c for d in controls) for c in controls):
            raise ValueError("control strings must not overlap")
        either = "|".join(f"{re.escape(c[0])}(?=\\\\*{re.escape(c[1:])})" for c in controls)
        self._inside = re.compile(f"({either})")
        self._guarded = re.compile(f"({either})\\\\")

    def escape(self, text: str) -> str:
        return self._inside.sub(r"\1\\", text)

    def unescape(self, text: str) -> str:
        return self._guarded.sub(r"\1", text)


class Reader:
    """Turns of the format, from pieces of a formatted conversation."""

    def __init__(self, guard: Guard):
        self.guard, self.held, self.at = guard, "", 0

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn that has become complete."""
        self.held, self.at = self.held[self.at :] + text, 0
        while turn := self._turn():
            yield turn

    def _turn(self) -> tuple[str, str] | None:
        text, a = self.held, self.at
        if text.startswith("[INST]", a):
            open_, close = "[INST] ", " [/INST]"
        elif text.startswith("[ROLE]", a):
            open_, close = "[ROLE]", "[/ROLE]"
        else:
            open_, close = "", "</s>"
            if any(c.startswith(text[a:]) for c in ("[INST]", "[ROLE]")):
                return None  # the beginning of a mark, so far
        end = text.find(close, a + len(open_))
        if end < 0:
            return None
        inner, self.at = text[a + len(open_) : end], end + len(close)
        if open_ == "[ROLE]":
            role, _, inner = inner.partition("[TEXT]")
            return self.guard.unescape(role), self.guard.unescape(inner)
        return ("user" if open_ else "assistant"), self.guard.unescape(inner)

    def finish(self) -> None:
        if self.held[self.at :]:
            raise ValueError("a turn has no end")


FORMATTED = "conv_id long, part long, text string, loss array<struct<s:long,e:long>>"
_LOSS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
_CHUNK = 1 << 18  # characters of a row of formatted text


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            yield from zip(*[batch.column(c).slice(i, 256).to_pylist() for c in columns], strict=True)


def _by_conversation(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(id, stream of its rows) of sorted rows; a stream is read before the next."""
    row = next(rows, None)
    while row is not None:
        name = row[0]

        def own() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[0] == name:  # noqa: B023
                yield row
                row = next(rows, None)

        yield name, own()


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Rows of formatted text by ``conv_id`` and ``part``, each with the spans (code
    points within the row) that a model learns.

    Turns go by ``turn`` (null first), then role and text; repeated turns are kept.
    Null roles and texts are empty; rows without ``conv_id`` are one conversation.
    A task reads its conversations turn by turn and holds one turn and one row of
    formatted text, so a conversation of any length passes.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, {"guard": Guard().escape})
        out: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            nonlocal held
            kinds = (pa.int64(), pa.int64(), pa.string(), _LOSS)
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            held = 0
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "text", "loss"])

        for name, turns in _by_conversation(_rows(batches, "conv_id", "role", "text")):
            pieces, spans, size, part = [], [], 0, 0
            messages = ({"role": role or "", "text": text or ""} for _, role, text in turns)
            for text, learned in compiled.render(messages=messages):
                if learned:
                    spans.append({"s": size, "e": size + len(text)})
                pieces.append(text)
                size += len(text)
                if size >= _CHUNK:
                    out.append((name, part, "".join(pieces), spans))
                    held, pieces, spans, size, part = held + size, [], [], 0, part + 1
                    if held >= 8 * _CHUNK:
                        yield batch()
            for _ in turns:  # a template may leave turns unread
                pass
            out.append((name, part, "".join(pieces), spans))
            held += size
            if held >= 8 * _CHUNK or len(out) >= 5000:
                yield batch()
        if out:
            yield batch()

    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    return (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions(*order)
        .mapInArrow(render, FORMATTED)
    )


def read_formatted(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation holds: ``conv_id``, ``n_turns``,
    ``turns_sha256`` (role, line feed, text, line feed of each turn),
    ``loss_chars`` and ``loss_sha256`` (of what a model learns, unescaped) and
    ``formatted_chars``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guard, out = Guard(), []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for name, parts in _by_conversation(_rows(batches, "conv_id", "text", "loss")):
            reader, turns, loss = Reader(guard), hashlib.sha256(), hashlib.sha256()
            n, chars, learned = 0, 0, 0
            for _, text, spans in parts:
                chars += len(text)
                for span in spans:
                    plain = guard.unescape(text[span["s"] : span["e"]])
                    learned += len(plain)
                    loss.update(plain.encode())
                for role, said in reader.feed(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
            reader.finish()
            out.append((name, n, turns.hexdigest(), learned, loss.hexdigest(), chars))
            if len(out) >= 5000:
                yield batch()
        if out:
            yield batch()

    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part")
        .mapInArrow(
            read,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )
