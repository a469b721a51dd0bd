"""Chat formatting: budgeted, turn-aligned windows with a loss mask.

Turns are written with a template. Prefix sums of turn tokens choose which new turns a window
takes; it starts with the system turn and a limited number of tokens of history. Assistant text
is a target only where its turn is new, so the mask holds each target once.

The system turn is the first one of that role, wherever it stands: every window after its own
starts with it, whatever its length. Where it takes more than half the budget, the other turns of a
window still get half of it, and the window is marked ``over_budget``. Later system turns are turns
like any other.

Defined results: null text is empty, a null role stays null, a null conversation id is a
conversation of its own. Rows are ordered by turn (null first), then role and text, so ties and
repeated rows have one order. A turn that alone exceeds the budget gets a window of its own.
Other columns are ignored. An empty table gives no windows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import batch_of, in_batches

# The template. A marker and the text beside it are parted by one space, so that the end of a
# text never runs into a marker. Any other role carries its name as a JSON string.
MARKERS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    None: ("[TURN]", "[/TURN]"),
}
_CONTROL = r"<s>|</s>|\[/?INST\]|<</?SYS>>|\[/?TURN\]"
_ESCAPE = re.compile(rf"(\\*)({_CONTROL})")
_UNESCAPE = re.compile(rf"\\(\\*)({_CONTROL})")
_MARK = re.compile(rf"(?<!\\)(?:{_CONTROL})")

WINDOWS = (
    "conv_id bigint, window int, text string, n_context int, n_turns int, n_tokens bigint, "
    "over_budget boolean, loss array<struct<start:bigint,end:bigint>>"
)


def escape(text: str) -> str:
    """One more backslash before every control string, however many it has already."""
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(role: str | None, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its escaped text starts and ends."""
    known = role in ("system", "user", "assistant")
    begin, end = MARKERS[role if known else None]
    head = f"{begin} " if known else f"{begin} {json.dumps(role)} "
    body = escape(text)
    return f"{head}{body} {end}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str | None, str]]:
    """The turns of a formatted window."""
    turns, at = [], 0
    opening = {begin: (role, end) for role, (begin, end) in MARKERS.items()}
    while match := _MARK.search(formatted, at):
        role, end = opening[match[0]]
        start = match.end() + 1
        close = _MARK.search(formatted, start)
        if close is None or close[0] != end:
            raise ValueError("not in the template")
        body = formatted[start : close.start() - 1]
        if role is None:
            role, used = json.JSONDecoder().raw_decode(body)
            body = body[used + 1 :]
        turns.append((role, unescape(body)))
        at = close.end()
    return turns


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "windows", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _windows_of(turns: Iterator[tuple], conv_id, budget: int, history: int):
    """Windows of one conversation, reading its turns one by one.

    Held in memory: the open window (at most the budget, or one turn), the system turn and the
    history. ``turns`` are (role, text, tokens of the turn in the template).
    """
    system = None  # once its own window is closed
    past: deque = deque()  # turns before the window, newest last, at most ``history`` tokens
    past_tokens = number = 0
    new: list = []
    new_tokens = 0

    def close():
        nonlocal number
        context = ([system] if system else []) + used
        pieces, spans, at = [], [], 0
        for place, turn in enumerate(context + new):
            if place >= len(context) and turn[0] == "assistant":
                spans.append({"start": at + turn[2], "end": at + turn[3]})
            pieces.append(turn[1])
            at += len(turn[1])
        tokens = sum(turn[4] for turn in context + new)
        row = (conv_id, number, "".join(pieces), len(context), len(new), tokens, tokens > budget, spans)
        number += 1
        return row

    def room() -> int:
        kept = system[4] if system else 0
        return max(budget - kept, budget // 2) - sum(turn[4] for turn in used)

    used: list = []
    for role, text, tokens in turns:
        piece, start, end = render(role, text)
        turn = (role, piece, start, end, tokens)
        if new and new_tokens + tokens > room():
            yield close()
            for old in new:
                if system is None and old[0] == "system":
                    system = old
                else:
                    past.append(old)
                    past_tokens += old[4]
            while past and past_tokens > history:
                past_tokens -= past.popleft()[4]
            new, new_tokens, used = [], 0, list(past)
            while used and tokens > room():
                used.pop(0)
        new.append(turn)
        new_tokens += tokens
    if new:
        yield close()


def _counted(batches: Iterator[pa.RecordBatch], vocabulary: str):
    """Rows with the number of tokens of their turn in the template."""
    encoding = _encoding(vocabulary)
    for batch in batches:
        turns = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
        tokens = [len(encoding.encode_ordinary(render(*turn)[0])) for turn in turns]
        columns = [*batch.columns, pa.array(tokens, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "tokens"])


def _format(batches, budget: int, history: int):
    from itertools import groupby

    names = [part.split()[0] for part in WINDOWS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(),
             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    out: list[tuple] = []
    size = 0

    def batch():
        return batch_of({n: (list(v), k) for n, v, k in zip(names, zip(*out), kinds)})

    for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
        turns = (row[1:] for row in rows)
        for window in _windows_of(turns, conv_id, budget, history):
            out.append(window)
            size += len(window[2])
            if size > 4_000_000:
                yield batch()
                out, size = [], 0
    if out:
        yield batch()


def format_chats(
    conversations: DataFrame, vocabulary: str, budget: int = 2048, history: int = 512
) -> DataFrame:
    """Windows (``WINDOWS``) of conversations with conv_id, turn, role, text.

    ``vocabulary`` is a rank file. Turns are tokenised where they are read, then dealt by
    conversation and read in order, so a task holds one window and its history and only adds up
    counts, however long a conversation is.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("bigint"), "turn", "role", text.alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    counted = in_batches(rows, partial(_counted, vocabulary=vocabulary), f"{kinds}, tokens bigint")
    ordered = (
        counted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text", "tokens")
    )
    return in_batches(ordered, partial(_format, budget=budget, history=history), WINDOWS)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint, n_windows bigint"
)


def _digest(batches):
    from itertools import groupby

    names = [part.split()[0] for part in DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    out = []
    for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = windows = 0
        for _, text, n_context, spans in rows:
            for role, said in parse(text)[n_context:]:
                turns.update(f"{role or ''}\n{said}\n".encode())
                n_turns += 1
            for span in spans:
                target = unescape(text[span["start"] : span["end"]])
                loss.update(target.encode())
                loss_chars += len(target)
            chars += len(text)
            windows += 1
        out.append(
            (conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, windows)
        )
        if len(out) >= 5000:
            yield batch_of({n: (list(v), k) for n, v, k in zip(names, zip(*out), kinds)})
            out = []
    if out:
        yield batch_of({n: (list(v), k) for n, v, k in zip(names, zip(*out), kinds)})


def read_back(windows: DataFrame) -> DataFrame:
    """Digests (``DIGESTS``) of what the windows of each conversation say."""
    ordered = (
        windows.select("conv_id", "window", "text", "n_context", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "window")
        .select("conv_id", "text", "n_context", "loss")
    )
    return in_batches(ordered, _digest, DIGESTS)
