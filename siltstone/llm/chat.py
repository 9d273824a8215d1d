"""Chat formatting by incremental rendering of a template that is taken as a black box.

``render`` turns a list of (role, text) into one string. For each turn the operator renders the conversation up to it and up
to the turn before; if the longer output continues the shorter one, what it adds is the turn's span. If not, the template
rewrites history (it drops thoughts of earlier turns, moves a system text...), and the conversation is reported as such.

Prefixes are rendered whole, as the template is a black box, up to ``WHOLE`` characters a conversation (turns times characters).
What a longer conversation's whole prefixes would cost grows with the square of its turns. There a turn is rendered behind the first and
the last few turns, and the joined spans are held against one render of the whole conversation: where the two differ, or any span
rewrites, or probes show that the template looks further back, whole prefixes are rendered all the same. So results are those of
whole prefixes at any length; only a template that rewrites a long conversation, unseen by the probes, and then takes it back to the letter
would be missed. The default template adds up turn by turn, as its definition shows, and needs no such render: memory never
holds more than ``WHOLE`` characters of a conversation.

Rows are sorted by turn; ties (the same turn number twice) by role and text. Null texts are empty, null roles the empty role,
rows without conv_id make one conversation of their own. An empty table gives no rows. Only conv_id, turn, role and text are read, so
other columns may have any names. With templates other than the default a task holds one conversation in memory.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded_batches, text_of

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

#: Turns times characters up to which a conversation is rendered by whole prefixes outright.
WHOLE = 4 << 20

BEGIN, MIDDLE, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that some template gives a meaning; inside texts they are escaped.
CONTROL = re.compile(r"<(?=\||s>|/s>|<SYS>>|</SYS>>)|\[(?=/?INST\])")


def escape(text: str) -> str:
    """Backslashes are doubled and one stands behind the first character of each control string."""
    return CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def turn_template(turns: list[Turn]) -> str:
    """The default template: marks around each turn, texts and roles escaped reversibly."""
    return "".join(f"{BEGIN}{quote(role, safe='')}{MIDDLE}{escape(text)}{END}\n" for role, text in turns)


def read_span(span: str) -> Turn:
    """The turn that ``turn_template`` wrote as ``span``."""
    role, _, rest = span.removeprefix(BEGIN).partition(MIDDLE)
    return unquote(role), unescape(rest[: -len(END) - 1])


def loss_part(span: str) -> tuple[int, int]:
    """Where an assistant turn's escaped text stands within its span: what the loss covers."""
    return span.index(MIDDLE) + len(MIDDLE), len(span) - len(END) - 1


def spans(render: Render, turns: list[Turn]) -> Iterator[tuple[str, bool]]:
    """For each turn the text that it adds to the prefix before it, and whether the template rewrote that (then the text is the whole new output)."""
    shorter = ""
    for k in range(len(turns)):
        longer = render(turns[: k + 1])
        yield (longer[len(shorter) :], False) if longer.startswith(shorter) else (longer, True)
        shorter = longer


def near_spans(render: Render, turns: Iterable[Turn], context: int) -> Iterator[tuple[str, bool]]:
    """As ``spans``, but behind the first and the last ``context`` turns only."""
    first: list[Turn] = []
    recent: list[Turn] = []
    for turn in turns:
        before = first + recent
        shorter, longer = render(before) if before else "", render([*before, turn])
        yield (longer[len(shorter) :], False) if longer.startswith(shorter) else (longer, True)
        if not first:
            first = [turn]
        else:
            recent = [*recent, turn][-context:] if context else []


def is_local(render: Render, context: int, trials: int = 20, seed: int = 0) -> bool:
    """Whether spans after a bounded context equal spans after whole prefixes, on probing conversations."""
    rng = random.Random(seed)
    for _ in range(trials):
        turns = [(rng.choice(("system", "user", "assistant")), rng.choice(("", "a", "<think>x</think> y", "</s>[INST] ok [/INST]", "two\nlines"))) for _ in range(context + 8)]
        if list(spans(render, turns)) != list(near_spans(render, turns, context)):
            return False
    return True


def checked_spans(render: Render, turns: list[Turn], context: int | None) -> Iterator[tuple[str, bool]]:
    """The spans of whole prefixes; those of long conversations by a bounded context, if the whole output confirms them."""
    if context is not None and len(turns) * sum(len(text) for _, text in turns) > WHOLE:
        found = list(near_spans(render, turns, context))
        if not any(rewrites for _, rewrites in found) and "".join(span for span, _ in found) == render(turns):
            return iter(found)
    return spans(render, turns)


def streamed_spans(render: Render, turns: Iterator[Turn], context: int) -> Iterator[tuple[str, bool]]:
    """As ``checked_spans`` for a template that adds up turn by turn: turns beyond ``WHOLE`` are never held."""
    held: list[Turn] = []
    size = 0
    for turn in turns:
        held.append(turn)
        size += len(turn[1])
        if len(held) * size > WHOLE:
            return near_spans(render, chain(held, turns), context)
    return spans(render, held)


def format_chats(df: DataFrame, render: Render = turn_template, loss: Callable[[str], tuple[int, int]] = loss_part, context: int = 2, learns: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn, in order: conv_id, turn, role, span_start, span_end, loss_start, loss_end (null without loss), rewrites, span.

    Offsets are those in the output up to the turn. A turn that rewrites what stood before it has that whole output as span and no
    loss, and offsets of turns before it hold no longer.
    """
    additive = render is turn_template
    near = context if additive or is_local(render, context) else None
    out = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), *((c, pa.int64()) for c in ("span_start", "span_end", "loss_start", "loss_end")), ("rewrites", pa.bool_()), ("span", pa.string())]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), out, strict=True)], names=[n for n, _ in out]) if rows else pa.RecordBatch.from_pylist([], pa.schema(out))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        rows, size = [], 0
        for key, group in groupby(stream, lambda row: row[0]):
            named: deque[tuple] = deque()  # turn and role of the rows whose spans are still to come

            def turns(group: Iterator[tuple] = group, named: deque[tuple] = named) -> Iterator[Turn]:
                for _, turn, role, text in group:
                    named.append((turn, role))
                    yield role, text

            found = streamed_spans(render, turns(), context) if additive else checked_spans(render, list(turns()), near)
            at = 0
            for span, rewrites in found:
                turn, role = named.popleft()
                start = 0 if rewrites else at
                at = start + len(span)
                part = loss(span) if role in learns and not rewrites else (None, None)
                rows.append((key, turn, role, start, at, *(None if p is None else start + p for p in part), rewrites, span))
                size += len(span)
                if size > 1 << 20 or len(rows) >= 10_000:
                    yield batch_of(rows)
                    rows, size = [], 0
        yield batch_of(rows)

    return bounded_batches(ordered(df)).mapInArrow(formatted, "conv_id long, turn long, role string, span_start long, span_end long, loss_start long, loss_end long, rewrites boolean, span string")


def ordered(df: DataFrame) -> DataFrame:
    """A conversation's rows in one partition, in order; Spark sorts them on disk where they are many."""
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def digests(formatted: DataFrame, read: Callable[[str], Turn] = read_span) -> DataFrame:
    """Per conversation what the formatted output holds when it is read back, hashed turn by turn as the rows stream by."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites"]

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def row() -> tuple:
            return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5], state[6]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if state is None or state[0] != r["conv_id"]:
                    if state is not None:
                        done.append(row())
                    state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text = read(r["span"])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if r["loss_start"] is not None:
                    learnt = unescape(r["span"][r["loss_start"] - r["span_start"] : r["loss_end"] - r["span_start"]])
                    state[3] += len(learnt)
                    state[4].update(learnt.encode("utf-8", "surrogatepass"))
                state[5] = r["span_end"]
                state[6] += r["rewrites"]
            yield batch_of(done)
        if state is not None:
            yield batch_of([row()])

    return formatted.mapInArrow(read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_rewrites long")
