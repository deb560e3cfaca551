"""Chat formatting by incremental black-box rendering.

A template is any function from a list of turns (role, text) to a string; nothing is known of its inside. The turns of
a conversation are rendered as growing prefixes. If each output begins with the one before, the rest is the new turn's
span; if not, the template rewrites history, which is reported. A turn rendered with a mark in place of its text shows
where in the span the text lies, which gives the loss mask.

Rows of a conversation pass through a task in order of turn, then role, then text. A prefix is the whole conversation
so far, so the task holds it, and rendering it takes time with the square of its turns: nothing less is right for a
template of which nothing is known. A template may be declared ``stateless``: then a turn is rendered with the first and
the last ``WINDOW`` turns. The declaration is checked: at twice the window and each doubling, and at the end of the
conversation, the whole prefix is rendered and compared with the joined parts, which stays linear in the sum of turns. At
the first difference the declaration is void: the conversation's turns since the last check are rendered again as whole
prefixes, as are all that follow, so the spans are those of an undeclared template. Parts are handed on once checked.
One conversation's digest is a chain over its turns and is computed in one task.

Null roles and texts count as empty. A null conversation id is one conversation. Repeated rows are turns of their own.
Extra columns, whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from touchline.llm.common import ddl

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Turns before the present one that are rendered again with it, for templates declared stateless.
WINDOW = 32
#: A private-use character, which no template writes by itself.
MARK = "\ue000"

#: Control strings of the template below.
OPEN, NAMED, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:\\(?:\\|###|</turn>|:)|[^\\:])*): ((?:\\(?:\\|###|</turn>)|(?!###|</turn>)[^\\])*+)</turn>\n")


def stateless(template: Template) -> Template:
    """Declare that a template writes each turn by itself, whatever comes before it; only such ones allow a window."""
    template.stateless = True
    return template


def escape(text: str) -> str:
    """Put a backslash before each control string and each backslash."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@stateless
def marked_turns(turns: list[Turn]) -> str:
    """The template of the registered query: ``### role: text</turn>`` and a line break for each turn."""
    return "".join(
        f"{OPEN}{_ROLE_CONTROL.sub(r'\\\g<0>', role)}{NAMED}{escape(text)}{CLOSE}" for role, text in turns
    )


def read_turns(formatted: str) -> list[Turn]:
    """The turns back from the output of ``marked_turns``."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


@dataclass
class Span:
    """What one turn adds to the output, where its text lies in it, and whether earlier output has changed."""

    role: str
    added: str
    start: int
    end: int
    rewrites: bool


class Renderer:
    """Renders one conversation turn by turn, over whole prefixes or, if the template is stateless, a window."""

    def __init__(self, template: Template, window: int | None = None):
        self.template, self.window = template, _allowed(template, window)
        self.turns: list[Turn] = []
        self.before = template([])
        #: Spans not compared with a whole prefix yet, the output up to the last that was, and its number of turns.
        self.open: list[Span] = []
        self.checked, self.n_checked = self.before, 0

    def add(self, role: str, text: str) -> list[Span]:
        """Take a turn; the spans that are certain by now, in order."""
        self.turns.append((role, text))
        if self.window is None:
            self.before, span = self._span(self.turns[:-1], self.before, role, text)
            return [span]
        self.open.append(self._windowed())
        if len(self.turns) <= self.window + 1:
            return self._agreed(self.before)  # the window holds the whole prefix
        return self.check() if len(self.turns) >= 2 * max(self.n_checked, self.window) else []

    def _windowed(self) -> Span:
        turns = self.turns[:-1]
        before = self.before
        if len(turns) > self.window + 1:
            turns = turns[:1] + turns[-self.window :]
            before = self.template(turns)
        self.before, span = self._span(turns, before, *self.turns[-1])
        return span

    def _agreed(self, whole: str) -> list[Span]:
        spans, self.open = self.open, []
        self.checked, self.n_checked = whole, len(self.turns)
        return spans

    def check(self) -> list[Span]:
        """Compare what is open with the whole prefix; the spans, those of whole prefixes if they differ."""
        if not self.open:
            return []
        whole = self.template(self.turns)
        joined = "".join([self.checked, *(span.added for span in self.open)])
        if whole == joined and not any(span.rewrites for span in self.open):
            return self._agreed(whole)
        self.window, self.open = None, []
        self.before, spans = self.checked, []
        for number in range(self.n_checked, len(self.turns)):
            self.before, span = self._span(self.turns[:number], self.before, *self.turns[number])
            spans.append(span)
        return spans

    def _span(self, turns: list[Turn], before: str, role: str, text: str) -> tuple[str, Span]:
        """The output with one more turn, and what that turn adds to ``before``, the output without it."""
        output = self.template([*turns, (role, text)])
        rewrites = not output.startswith(before)
        begin = _shared(before, output) if rewrites else len(before)
        marked = self.template([*turns, (role, MARK)])
        place = marked.find(MARK, begin)
        after = len(marked) - place - 1
        start, end = (place - begin, len(output) - after - begin) if place >= 0 else (0, 0)
        return output, Span(role, output[begin:], start, max(start, end), rewrites)


def _allowed(template: Template, window: int | None) -> int | None:
    """The window to render with; None is whole prefixes."""
    if getattr(template, "stateless", False):
        return WINDOW if window is None else window
    if window is not None:
        raise ValueError("a window needs a template that is declared stateless")
    return None


def _shared(one: str, other: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if one[:middle] == other[:middle] else (low, middle - 1)
    return low


def _in_order(conversations: DataFrame, key: str) -> DataFrame:
    rows = conversations.select(key, "turn", "role", "text")
    return rows.repartition(key).sortWithinPartitions(key, "turn", "role", "text")


def _rendered(
    batches: Iterator[pa.RecordBatch], template: Template, window: int | None
) -> Iterator[list[tuple[object, int, Span]]]:
    """Some at a time, in order: conversation, number of the turn, span."""
    now, renderer, number = object(), None, 0
    spans: list[tuple[object, int, Span]] = []

    def take(certain: list[Span]) -> None:
        nonlocal number
        for span in certain:
            spans.append((now, number, span))
            number += 1

    for batch in batches:
        for key, role, text in zip(*(batch.column(at).to_pylist() for at in (0, 2, 3)), strict=True):
            if renderer is None or key != now:
                if renderer is not None:
                    take(renderer.check())
                now, renderer, number = key, Renderer(template, window), 0
            take(renderer.add(role or "", text or ""))
        yield spans
        spans = []
    if renderer is not None:
        take(renderer.check())
        yield spans


def format_turns(
    conversations: DataFrame,
    template: Template = marked_turns,
    trained: tuple[str, ...] = ("assistant",),
    key: str = "conv_id",
    window: int | None = None,
) -> DataFrame:
    """Each turn's part of the output, in order of ``position``; joined, they are the formatted conversation.

    ``loss_start`` and ``loss_end`` are the part of it to train on (null for other roles), in characters from the
    beginning of ``formatted``; ``rewrites`` is true where a turn changes output before it. A ``window`` is refused
    unless the template is declared ``stateless``.
    """
    _allowed(template, window)
    names = [key, "position", "role", "formatted", "loss_start", "loss_end", "rewrites"]
    types = [_arrow_type(conversations.select(key)), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(),
             pa.bool_()]
    schema = (
        f"{ddl(conversations, key)}, position long, role string, formatted string, loss_start long, loss_end long, "
        "rewrites boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for spans in _rendered(batches, template, window):
            rows = [
                (key_, number, span.role, span.added,
                 *((span.start, span.end) if span.role in trained else (None, None)), span.rewrites)
                for key_, number, span in spans
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names
            )

    return _in_order(conversations, key).mapInArrow(run, schema)


def _arrow_type(column: DataFrame) -> pa.DataType:
    return to_arrow_type(column.schema.fields[0].dataType)


class _Digest:
    """What is read back from the parts of one conversation, as they come."""

    def __init__(self, trained: tuple[str, ...]):
        self.trained = trained
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.rewrites = False

    def add(self, span: Span) -> None:
        for role, text in read_turns(span.added):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if span.role in self.trained:
            masked = unescape(span.added[span.start : span.end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())
        self.chars += len(span.added)
        self.rewrites |= span.rewrites

    def row(self) -> tuple:
        return (self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.rewrites)


def conversation_digests(
    conversations: DataFrame,
    trained: tuple[str, ...] = ("assistant",),
    key: str = "conv_id",
    window: int | None = None,
) -> DataFrame:
    """Format with ``marked_turns`` and read the output back, per conversation.

    ``n_turns`` and ``turns_sha256`` come from the parsed output, ``loss_chars`` and ``loss_sha256`` from the text
    under the mask, ``formatted_chars`` is the output's length and ``rewrites_history`` whether any turn changed it.
    """
    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"]
    types = [_arrow_type(conversations.select(key)), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(),
             pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for spans in _rendered(batches, marked_turns, window):
            done = []
            for key_, number, span in spans:
                if number == 0:
                    if digest is not None:
                        done.append((now, *digest.row()))
                    now, digest = key_, _Digest(trained)
                digest.add(span)
            if done:
                yield table(done)
        if digest is not None:
            yield table([(now, *digest.row())])

    schema = (
        f"{ddl(conversations, key)}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewrites_history boolean"
    )
    return _in_order(conversations, key).mapInArrow(run, schema)
