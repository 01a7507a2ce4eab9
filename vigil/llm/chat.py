r"""Chat formatting into budgeted windows.

A conversation becomes one or more windows of whole turns. A running prefix sum of
turn tokens closes a window where the next turn would exceed the budget. Every
later window starts with the conversation's system turn (a first turn whose role is
``system``), whatever its length, and the last turns before it, as far as the history
limits and the budget allow. The system turn counts towards the budget; a window that
it and one new turn alone take above the budget is marked. Context turns are repeated without loss; the loss mask covers the text
of each assistant turn where it is new, so every target counts once.

Template: ``<turn ROLE>\nTEXT</turn>\n``. Inside ROLE and TEXT a backslash, ``<`` and
``>`` are escaped by a backslash, so no text can open or close a turn, and reading
back gives every text as it was.

Rows are dealt by conversation and sorted inside their partition. A task reads them
as a stream and holds one window and the history, however long the conversation is.

Edge cases: null text and role are empty; a null conv_id is one conversation; a null
turn comes first; rows with equal turns are ordered by role and text, and all are
kept; a turn above the budget is a window of its own, whole; an empty text has an
empty loss span; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

BUDGET, HISTORY_TURNS, HISTORY_TOKENS = 1024, 4, 256
TURN_OVERHEAD, CHARS_PER_TOKEN = 8, 4
WINDOW_FIELDS = ("window int, text string, loss array<struct<start: int, end: int>>, "
                 "n_context int, n_turns int, n_tokens bigint, over_budget boolean")
FLUSH_CHARS = 1 << 22

_SPECIAL = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_INSIDE = r"([^\\<>]*(?:\\.[^\\<>]*)*)"
_TURN = re.compile(rf"<turn {_INSIDE}>\n{_INSIDE}</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(window: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window."""
    return [(unescape(m.group(1)), unescape(m.group(2))) for m in _TURN.finditer(window)]


def count_tokens(text: str) -> int:
    """Estimated tokens of a turn with its marks."""
    return TURN_OVERHEAD + -(-len(text) // CHARS_PER_TOKEN)


@dataclass
class Limits:
    budget: int = BUDGET
    history_turns: int = HISTORY_TURNS
    history_tokens: int = HISTORY_TOKENS


@dataclass
class Turn:
    role: str
    text: str
    tokens: int


@dataclass
class Conversation:
    """The open window of the conversation that is being read."""

    limits: Limits
    system: Turn | None = None
    seen: int = 0
    number: int = 0
    context: list[Turn] = field(default_factory=list)
    fresh: list[Turn] = field(default_factory=list)
    used: int = 0
    recent: deque[Turn] = field(default_factory=deque)

    def add(self, turn: Turn) -> dict | None:
        """Take the next turn; the window it closed, if it closed one."""
        done = None
        if self.fresh and self.used + turn.tokens > self.limits.budget:
            done = self.close()
            self._open(turn)
        if self.seen == 0 and turn.role == "system":
            self.system = turn
        else:
            self.recent.append(turn)
            while len(self.recent) > self.limits.history_turns:
                self.recent.popleft()
        self.seen += 1
        self.fresh.append(turn)
        self.used += turn.tokens
        return done

    def _open(self, turn: Turn) -> None:
        """Start a window for a turn: always with the system turn, and as much history as
        the budget leaves beside the two. Where they alone exceed it the window is marked."""
        self.context = [self.system] if self.system else []
        room = min(self.limits.budget - turn.tokens - sum(t.tokens for t in self.context), self.limits.history_tokens)
        history: deque[Turn] = deque()
        for t in reversed(self.recent):
            if t.tokens > room:
                break
            history.appendleft(t)
            room -= t.tokens
        self.context += history
        self.fresh, self.used = [], sum(t.tokens for t in self.context)

    def close(self) -> dict:
        """The open window as a row."""
        parts, loss, at = [], [], 0
        for k, t in enumerate([*self.context, *self.fresh]):
            head, body = f"<turn {escape(t.role)}>\n", escape(t.text)
            if k >= len(self.context) and t.role == "assistant":
                loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
            part = f"{head}{body}</turn>\n"
            parts.append(part)
            at += len(part)
        row = {"window": self.number, "text": "".join(parts), "loss": loss, "n_context": len(self.context),
               "n_turns": len(self.fresh), "n_tokens": self.used, "over_budget": self.used > self.limits.budget}
        self.number += 1
        return row


def _format(rows: Iterable[tuple], limits: Limits) -> Iterator[dict]:
    """Window rows of (conv_id, role, text) rows in order."""
    conv, open_id = None, None
    for conv_id, role, text in rows:
        if conv is None or conv_id != open_id:
            if conv is not None:
                yield {"conv_id": open_id} | conv.close()
            conv, open_id = Conversation(limits), conv_id
        done = conv.add(Turn(role or "", text or "", count_tokens(text or "")))
        if done:
            yield {"conv_id": open_id} | done
    if conv is not None:
        yield {"conv_id": open_id} | conv.close()


def _batched(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for r in rows:
        held.append(r)
        chars += len(r.get("text") or "")
        if len(held) >= 1000 or chars >= FLUSH_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def format_windows(turns: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(conv_id, turn, role, text) → one row per window, the windows of a
    conversation in order within one partition."""
    small_batches(turns.sparkSession)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    dealt = turns.select(*order).repartition("conv_id").sortWithinPartitions(*order)
    loss = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                kind[:] = [b.schema.field("conv_id").type]
                yield from zip(*[b.column(c).to_pylist() for c in ("conv_id", "role", "text")])

        windows = _format(rows(), limits)
        first = next(windows, None)
        if first is None:
            return
        schema = pa.schema([("conv_id", kind[0]), ("window", pa.int32()), ("text", pa.string()), ("loss", loss),
                            ("n_context", pa.int32()), ("n_turns", pa.int32()), ("n_tokens", pa.int64()),
                            ("over_budget", pa.bool_())])
        yield from _batched(_chain(first, windows), schema)

    return dealt.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {id_type}, {WINDOW_FIELDS}")


def _chain(first: dict, rest: Iterator[dict]) -> Iterator[dict]:
    yield first
    yield from rest


def _read(rows: Iterable[tuple]) -> Iterator[dict]:
    """Digest rows of (conv_id, text, loss, n_context) windows in order."""
    state, open_id = None, None

    def done() -> dict:
        n, turns, loss_chars, loss_hash, chars = state
        return {"conv_id": open_id, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars,
                "loss_sha256": loss_hash.hexdigest(), "formatted_chars": chars}

    for conv_id, text, loss, n_context in rows:
        if state is None or conv_id != open_id:
            if state is not None:
                yield done()
            state, open_id = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv_id
        for role, said in parse(text)[n_context:]:
            state[0] += 1
            state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
        for span in loss:
            target = unescape(text[span["start"]:span["end"]])
            state[2] += len(target)
            state[3].update(target.encode("utf-8", "surrogatepass"))
        state[4] += len(text)
    if state is not None:
        yield done()


def read_back(windows: DataFrame, in_order: bool = False) -> DataFrame:
    """Per conversation what its windows hold: turns, targets and sizes. ``in_order``
    says that the rows come straight from ``format_windows``, conversation by
    conversation; otherwise they are dealt and sorted first."""
    if not in_order:
        windows = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    id_type = windows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                kind[:] = [b.schema.field("conv_id").type]
                yield from zip(*[b.column(c).to_pylist() for c in ("conv_id", "text", "loss", "n_context")])

        found = _read(rows())
        first = next(found, None)
        if first is None:
            return
        schema = pa.schema([("conv_id", kind[0]), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        yield from _batched(_chain(first, found), schema)

    return windows.select("conv_id", "text", "loss", "n_context").mapInArrow(
        run, f"conv_id {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
             "loss_sha256 string, formatted_chars bigint")
