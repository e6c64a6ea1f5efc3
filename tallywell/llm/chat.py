"""Chat formatting by incremental rendering: the template is a black box from turns to one string."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.storage import fresh_path

Turn = tuple[str, str]  # role, text
Template = Callable[[list[Turn]], str]

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """A text without ``<|``: one backslash more between ``<`` and ``|``, however many there are."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_local(template: Template) -> Template:
    """Declare that ``template`` renders each turn by itself, but for the first turn and a few before."""
    template.turn_local = True
    return template


@turn_local
def marked_turns(turns: list[Turn]) -> str:
    """The default template: each turn between marks, role and text on lines of their own, control strings escaped."""
    return "".join(f"{OPEN}{_escape_role(role)}\n{escape(text)}{CLOSE}\n" for role, text in turns)


def parse_turns(formatted: str) -> list[Turn]:
    """The turns of a text that ``marked_turns`` made."""
    turns = []
    for chunk in formatted.split(f"{CLOSE}\n")[:-1]:
        if not chunk.startswith(OPEN):
            raise ValueError("turn without its mark")
        role, _, text = chunk[len(OPEN) :].partition("\n")
        turns.append((_unescape_role(role), unescape(text)))
    return turns


class RewrittenHistory(ValueError):
    """A later turn changed how an earlier one is rendered."""


@dataclass
class Renderer:
    """Renders a conversation turn by turn and finds the span of each turn.

    For each turn the prefixes without and with it are rendered and compared. If the first is not a prefix of the second,
    the template rewrites history. ``lookback``: a prefix is the first turn and this many turns before the new one, so
    memory and work per turn are bounded, but only right for a template that looks no further; None renders all turns.
    """

    template: Template
    lookback: int | None = None
    _first: list[Turn] = field(default_factory=list)
    _last: list[Turn] = field(default_factory=list)

    def add(self, turn: Turn) -> tuple[str, int, int]:
        """What this turn adds to the output, and the span of the turn's text in that.

        The span is found in outputs too: two texts of one character show what the template puts before and after.
        """
        before = self._first + self._last
        old, new = self.template(before) if before else "", self.template([*before, turn])
        if not new.startswith(old):
            raise RewrittenHistory(f"turn {turn[0]!r} changes earlier output")
        one, two = (self.template([*before, (turn[0], probe)]) for probe in "01")
        head = next((i for i, (x, y) in enumerate(zip(one, two)) if x != y), None)
        if head is None or head < len(old):
            raise ValueError("the output does not show the text of a turn")
        tail = len(one) - head - 1
        if self._first:
            self._last.append(turn)
            if self.lookback is not None and len(self._last) > self.lookback:
                del self._last[0]
        else:
            self._first.append(turn)
        return new[len(old) :], head - len(old), len(new) - tail - len(old)


def rewrites_history(template: Template, turns: list[Turn], lookback: int | None = None) -> bool:
    """Whether a turn of ``turns`` changes how an earlier one is rendered."""
    renderer = Renderer(template, lookback)
    try:
        for turn in turns:
            renderer.add(turn)
    except RewrittenHistory:
        return True
    return False


def _ordered(turns: DataFrame) -> DataFrame:
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def format_turns(
    turns: DataFrame, template: Template = marked_turns, learn: tuple[str, ...] = ("assistant",), lookback: int | None = None
) -> DataFrame:
    """One row per turn: conv_id, seq (from 0), added (what the turn adds to the conversation's output) and the span
    [loss_start, loss_end) in it, in code points, on which a model is trained (empty for roles not in ``learn``).

    Rows are ordered by turn; ties by role and text, so repeated rows are repeated turns; null turns come first, a
    null conv_id is one conversation, null roles and texts are empty. Other columns are ignored. The output of a
    conversation is its ``added`` in order; turns stream through the task that has the conversation. Each turn is
    rendered after all turns before it, which the task holds. With ``lookback``, for templates declared ``turn_local``
    only, it holds at most ``lookback`` + 1 of them. A template that rewrites history fails the job.
    """
    if lookback is not None and not getattr(template, "turn_local", False):
        raise ValueError("lookback needs a template declared turn_local")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, renderer, seq = object(), None, 0
        for batch in batches:
            out = {"conv_id": [], "seq": [], "added": [], "loss_start": [], "loss_end": []}
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != current or renderer is None:
                    current, renderer, seq = conv, Renderer(template, lookback), 0
                added, start, end = renderer.add((role, text))
                if role not in learn:
                    start = end = 0
                for name, value in zip(out, (conv, seq, added, start, end)):
                    out[name].append(value)
                seq += 1
            yield pa.RecordBatch.from_pydict(out, schema=_TURN_ARROW)

    return _ordered(turns).mapInArrow(run, "conv_id long, seq long, added string, loss_start long, loss_end long")


_TURN_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("seq", pa.int64()), ("added", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()),
])


def digest_output(
    formatted: DataFrame, parse: Callable[[str], list[Turn]] = parse_turns, plain: Callable[[str], str] = unescape
) -> DataFrame:
    """Read rows of ``format_turns`` back: per conversation the digests of its turns and of the text under the mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def close() -> dict[str, object]:
            turns, loss = state.pop("turns_sha256"), state.pop("loss_sha256")
            return {"conv_id": current, **state, "turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}

        for batch in batches:
            done = []
            for conv, added, start, end in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if state is None or conv != current:
                    if state is not None:
                        done.append(close())
                    current, state = conv, {"n_turns": 0, "loss_chars": 0, "formatted_chars": 0,
                                            "turns_sha256": hashlib.sha256(), "loss_sha256": hashlib.sha256()}
                for role, text in parse(added):
                    state["n_turns"] += 1
                    state["turns_sha256"].update(f"{role}\n{text}\n".encode())
                learned = plain(added[start:end])
                state["loss_chars"] += len(learned)
                state["loss_sha256"].update(learned.encode())
                state["formatted_chars"] += len(added)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_DIGEST_ARROW)
        if state is not None:
            yield pa.RecordBatch.from_pylist([close()], schema=_DIGEST_ARROW)

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "seq")]
    ordered = formatted.repartition("conv_id").sortWithinPartitions(*order)
    return ordered.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


_DIGEST_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def format_and_read(turns: DataFrame, **options: object) -> DataFrame:
    """Write the formatted turns to a new folder of the shared one and read the digests back from it.

    Null roles and texts are empty; turns of one number go in the order of role and text, repeated rows are turns of their own;
    turns of null conversations are one conversation; without turns there are no rows.
    """
    spark, path = turns.sparkSession, fresh_path(turns.sparkSession, "chat")
    written = format_turns(turns, **options)
    written.write.parquet(path)
    return digest_output(spark.read.schema(written.schema).parquet(path))
