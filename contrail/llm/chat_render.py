"""Operator 8: chat formatting by incremental black-box rendering.

The template is any function from a list of messages to text; nothing is known
of its inside.  The successive prefixes of a conversation are rendered, and
what one more turn adds is that turn's span.  A template that changes earlier
output when a turn is added is detected: the first such turn is reported and
its span begins where the two outputs part.  Inside the span of a trained turn
the place of its text is found by rendering it with one-letter and empty texts.

Every template is rendered on all prefixes, the registered one too, and each
output is compared with the one before it: neither the template's kind nor the
number of turns decides how spans are found.  The work is quadratic in the turns
of one conversation, as rendering the prefixes of an unknown function is, and
linear in conversations.  A trained turn whose text has no place of its own in
the output is listed as untold.

A conversation is one training sample, so its turns are read in order by one
task, one conversation and two of its prefixes in memory at a time; nothing else
is gathered.

Defined results: a null text is empty, a null role is the empty role; turns
come by (turn, role, text), nulls first, and repeated rows are turns of their
own; rows with a null conversation id form one conversation; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import settled

Message = tuple[str, str]                      # role, text
Template = Callable[[list[Message]], str]

TRAINED = ("assistant",)

# Fixed values of the marked-turn template
TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
OPEN, CLOSE = "### ", "</turn>"
_ROLES = {v: k for k, v in TITLES.items()}


# -- a reversible template -----------------------------------------------

def escape(text: str) -> str:
    """A backslash before each backslash, turn mark and end mark of the text."""
    return text.replace("\\", "\\\\").replace("###", "\\###").replace(CLOSE, "\\" + CLOSE)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _name(role: str) -> str:
    return TITLES.get(role) or "=" + escape(role).replace(":", "\\:")


def marked_turns(messages: list[Message]) -> str:
    """``### Role: text</turn>`` for each turn, a line break after it."""
    return "".join(f"{OPEN}{_name(role)}: {escape(text)}{CLOSE}\n" for role, text in messages)


_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|(?!</turn>)[^\\])*)</turn>\n", re.S)


def parse_marked(text: str) -> list[Message]:
    """The messages of a text made by :func:`marked_turns`."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        role = m[1]
        out.append((_ROLES[role] if role in _ROLES else unescape(role[1:]), unescape(m[2])))
        at = m.end()
    return out


# -- spans by rendering ---------------------------------------------------

def spans(messages: list[Message], template: Template, trained: tuple[str, ...] = TRAINED
          ) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]], int | None, list[int]]:
    """(text, turn spans, spans of trained texts, first turn that rewrote history, trained turns without a place)."""
    text, turns, loss, rewrote, untold = template([]), [], [], None, []
    for k, (role, said) in enumerate(messages):
        context = messages[:k]
        after = template([*context, (role, said)])
        kept = _shared(text, after)
        if kept < len(text) and rewrote is None:
            rewrote = k
        if role in trained:
            place = _place(context, role, said, after, template)
            if place is None:
                untold.append(k)
            else:
                loss.append(place)
        text = after
        turns.append((kept, len(text)))
    return text, turns, loss, rewrote, untold


def render(messages: list[Message], template: Template, trained: tuple[str, ...] = TRAINED
           ) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]], int | None]:
    """(text, turn spans, spans of trained texts, first turn that rewrote history)."""
    return spans(messages, template, trained)[:4]


def _shared(a: str, b: str) -> int:
    """The length of the longest common beginning."""
    same, differ = 0, min(len(a), len(b)) + 1         # beginnings of these lengths are alike, and not
    while differ - same > 1:
        mid = (same + differ) // 2
        same, differ = (mid, differ) if a[same:mid] == b[same:mid] else (same, mid)
    return same


def _place(context, role, said, after, template):
    """Where the last turn's text stands in the output, None if that can't be told."""
    x, y, none = (template([*context, (role, t)]) for t in ("x", "y", ""))
    start = _shared(x, y)
    end = start + len(after) - len(none)
    if after[:start] != none[:start] or after[end:] != none[start:]:
        return None
    return start, end


# -- Spark ----------------------------------------------------------------

SPANS = "array<struct<start:int,stop:int>>"
SCHEMA = f"conv_id long, text string, turns {SPANS}, loss {SPANS}, rewritten_at int, untold array<int>"
_ARROW = pa.schema([("conv_id", pa.int64()), ("text", pa.string())] + [
    (n, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))) for n in ("turns", "loss")
] + [("rewritten_at", pa.int32()), ("untold", pa.list_(pa.int32()))])


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Message]]]:
    """Runs of rows with one id."""
    held, at = None, None
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            for conv, role, text in zip(*(c.to_pylist() for c in batch.slice(i, 1024).columns)):
                if held is None or conv != at:
                    if held is not None:
                        yield at, held
                    held, at = [], conv
                held.append((role, text))
    if held is not None:
        yield at, held


def format_conversations(turns: DataFrame, template: Template = marked_turns,
                         trained: tuple[str, ...] = TRAINED) -> DataFrame:
    """(conv_id, text, turns, loss, rewritten_at, untold): a row a conversation."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for conv, messages in _conversations(batches):
            text, turn_spans, loss, rewrote, untold = spans(messages, template, trained)
            pairs = lambda s: [{"start": a, "stop": b} for a, b in s]
            held.append({"conv_id": conv, "text": text, "turns": pairs(turn_spans), "loss": pairs(loss),
                         "rewritten_at": rewrote, "untold": untold})
            size += len(text)
            if len(held) >= 256 or size > 1 << 22:
                yield pa.RecordBatch.from_pylist(held, _ARROW)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, _ARROW)

    t = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                     F.coalesce(turns["role"], F.lit("")).alias("role"),
                     F.coalesce(turns["text"], F.lit("")).alias("text"))
    return (t.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(rows, SCHEMA))


def digests(formatted: DataFrame, parse: Callable[[str], list[Message]] = parse_marked,
            undo: Callable[[str], str] = unescape) -> DataFrame:
    """What formatted conversations hold, read from their texts and masks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                out = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                       "formatted_chars", "rewritten_at")}
                for r in batch.slice(i, 256).to_pylist():
                    messages, seen = parse(r["text"]), hashlib.sha256()
                    for role, text in messages:
                        seen.update(f"{role}\n{text}\n".encode())
                    masked = "".join(undo(r["text"][s["start"]:s["stop"]]) for s in r["loss"])
                    for k, v in zip(out, (r["conv_id"], len(messages), seen.hexdigest(), len(masked),
                                          hashlib.sha256(masked.encode()).hexdigest(), len(r["text"]),
                                          r["rewritten_at"])):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("rewritten_at", pa.int32())])
    return formatted.mapInArrow(rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long, rewritten_at int")


def format_and_read(turns: DataFrame, folder: str) -> DataFrame:
    """Digests of the conversations, read back from the output."""
    return digests(settled(format_conversations(turns), folder, "formatted"))
