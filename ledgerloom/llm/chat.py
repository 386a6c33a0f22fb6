"""Conversations as formatted windows of a budget of tokens, with a loss mask.

A window is a span of whole turns.  The tokens of the turns are summed up along the
conversation, and a span ends where the sums say that the next turn would not fit.  In
front of a window's new turns stand the conversation's system turn and the last turns
before the span, up to a part of the budget.  What is repeated carries no loss: each
assistant turn is under the mask in one window, the one where it is new.

A turn that does not fit beside history or system turn has a window without them, over
the budget if it is longer than that, and a system turn of over half the budget is not
repeated.  So no turn is cut or dropped.

Turns are marked by control strings.  Where a text or role holds one, a backslash goes
between its first character and the rest, after any backslashes already there, so the
output parses without doubt and one backslash less gives the text back.

A conversation is cut into sections by the same sums, so a long one is formatted by many
tasks: running sums are made per range of the ordered turns and then put end to end.
Every section gets the turns before it that may be its history, and the system turn.

Turns are ordered by ``turn`` (null first), then role, then the MD5 of the text; equal
rows are all kept.  Null text and role are empty, a null ``conv_id`` is a conversation,
an empty table gives an empty result, other columns are ignored.  A text of any length is
held once by the task that formats it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import Encoder
from ledgerloom.llm.shared import pieces_of, share, shared_value, stored

#: The control strings of the template.
SYSTEM = ("<<SYS>>", "<</SYS>>")
USER = ("[INST]", "[/INST]")
ASSISTANT = ("<s>", "</s>")
OTHER = ("<<ROLE>>", "<</ROLE>>")
PAIRS = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}

_CONTROLS = [c for pair in (SYSTEM, USER, ASSISTANT, OTHER) for c in pair]
_PLAIN = re.compile("|".join(rf"{re.escape(c[0])}(?=\\*{re.escape(c[1:])})" for c in _CONTROLS))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\(?=\\*{re.escape(c[1:])})" for c in _CONTROLS))

#: Tokens of a window, of these for repeated turns, and of a section in windows.
BUDGET, HISTORY, SECTION = 2048, 512, 32
#: Characters of text encoded at a time.
AT_ONCE = 300_000


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m.group() + "\\", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0], text) if "\\" in text else text


def marks(role: str) -> tuple[str, str]:
    """What stands before and after the escaped text of a turn."""
    if role in PAIRS:
        return PAIRS[role]
    return OTHER[0] + escape(role) + OTHER[1] + USER[0], USER[1]


def parse(formatted: str, at: int = 0) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of formatted text from a turn's start on."""
    while at < len(formatted):
        if formatted.startswith(OTHER[0], at):
            end = formatted.index(OTHER[1], at)
            role, at = unescape(formatted[at + len(OTHER[0]) : end]), end + len(OTHER[1])
            before, after = USER
        else:
            role, (before, after) = next((r, p) for r, p in PAIRS.items() if formatted.startswith(p[0], at))
        if not formatted.startswith(before, at):
            raise ValueError(f"no turn at {at}")
        end = formatted.index(after, at + len(before))
        yield role, unescape(formatted[at + len(before) : end])
        at = end + len(after)


def spans(
    tokens: np.ndarray, first: int, system: int, budget: int, history: int, inside: bool = False
) -> list[tuple[int, int, int, bool]]:
    """Windows over turns ``first`` and later: (start of history, start, end, system turn repeated).

    ``tokens`` holds the turns in order, those before ``first`` may only be history;
    ``system`` is the size of the system turn to repeat (0: none), which with ``inside``
    is the first of the turns.
    """
    sums = np.concatenate([[0], np.cumsum(tokens)])
    out = []
    start = first
    while start < len(tokens):
        repeated = system > 0 and not (inside and start == 0)
        ahead = system if repeated else 0
        back = max(int(np.searchsorted(sums, sums[start] - history)), int(inside and start > 0))
        end = int(np.searchsorted(sums, sums[back] + budget - ahead, "right")) - 1
        if end <= start:  # the turn does not fit beside its history
            back = start
            end = int(np.searchsorted(sums, sums[start] + budget - ahead, "right")) - 1
        if end <= start:  # nor beside the system turn
            repeated, end = False, start + 1
        out.append((back, start, end, repeated))
        start = end
    return out


def write_window(repeated: list[tuple[str, str]], new: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]], int]:
    """Formatted text, spans of characters under the loss mask, and where the new turns begin."""
    out: list[str] = []
    loss: list[tuple[int, int]] = []
    size = fresh = 0
    for i, (role, text) in enumerate(repeated + new):
        if i == len(repeated):
            fresh = size
        before, after = marks(role)
        body = escape(text)
        if role == "assistant" and i >= len(repeated):
            loss.append((size + len(before), size + len(before) + len(body)))
        out += [before, body, after]
        size += len(before) + len(body) + len(after)
    return "".join(out), loss, fresh


TURN_TYPE = "conv_id long, turn long, role string, text string, tokens long"


def token_counter(encoder: Encoder) -> Callable[[list[str]], list[int]]:
    return lambda texts: [sum(map(len, chunks)) for chunks in encoder.encode_batch(texts)]


def counted_turns(conversations: DataFrame, make_counter: Callable, *args) -> DataFrame:
    """The turns with the tokens each takes when formatted."""
    shared = share(conversations.sparkSession, make_counter, *args)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared_value(shared)
        around: dict[str, int] = {}
        for b in batches:
            roles = [r or "" for r in b.column(2).to_pylist()]
            sizes: list[int] = []
            for part in pieces_of(b.column(3), AT_ONCE):
                sizes += count([escape(t) for t in part])
            for role in set(roles) - around.keys():
                if len(around) > 1000:
                    around.clear()
                around[role] = sum(count(list(marks(role))))
            total = [n + (around[r] if r in around else sum(count(list(marks(r))))) for n, r in zip(sizes, roles)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(roles, pa.string()), b.column(3), pa.array(total, pa.int64())],
                ["conv_id", "turn", "role", "text", "tokens"],
            )

    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).mapInArrow(counted, TURN_TYPE)


def sums_before(turns: DataFrame) -> DataFrame:
    """key, line, turn, role, tie, tokens and ``before``, the tokens of a conversation's earlier turns.

    A range of the ordered turns is summed for itself; a range starts where the earlier
    ranges of the conversation end.  Texts stay behind.
    """
    order = ["turn", "role", "tie", "line"]
    ranged = stored(
        turns.select("key", *order, "tokens")
        .repartitionByRange("key", *order)
        .withColumn("range", F.spark_partition_id())
    )
    # One row per conversation and range it lies in, at most as many as there are ranges.
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("key", "range")
        .agg(F.sum("tokens").alias("in_range"))
        .select("key", "range", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("key", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(offsets, ["key", "range"]).select(
        "key", *order, "tokens", (F.col("offset") + F.sum("tokens").over(inside) - F.col("tokens")).alias("before")
    )


def sections_of(turns: DataFrame, size: int, history: int, system: int) -> DataFrame:
    """line, section and use of turns outside section 0 or needed there by another section.

    use: 0 the system turn, 1 a turn that may be history, 2 a turn of the section.
    """
    placed = stored(sums_before(turns).withColumn("section", F.floor(F.col("before") / size)))
    own = placed.filter("section > 0").select("line", "section", F.lit(2).alias("use"))
    # Wherever the next section begins, its history begins at this sum or later.
    history_rows = placed.filter(F.col("before") >= (F.col("section") + 1) * size - history).select(
        "line", (F.col("section") + 1).alias("section"), F.lit(1).alias("use")
    )
    first = (
        placed.filter("before = 0")
        .groupBy("key")
        .agg(F.min(F.struct("turn", "role", "tie", "line", "tokens")).alias("s"))
        .filter((F.col("s.role") == "system") & (F.col("s.tokens") <= system))
        .select("key", "s.line")
    )
    later = placed.filter("section > 0").select("key", "section").distinct()
    system = later.join(first, "key").select("line", "section", F.lit(0).alias("use"))
    return own.unionByName(history_rows).unionByName(system)


WINDOW_TYPE = (
    "conv_id long, section long, window int, n_tokens long, text string, "
    "loss array<struct<start:int,end:int>>, new_from int"
)


def windows(
    conversations: DataFrame, file: str, budget: int = BUDGET, history: int = HISTORY, section: int | None = None
) -> DataFrame:
    """The formatted windows of ``conversations``; ``file`` is the tokenizer that counts.

    Columns: conv_id, section and window (their order), n_tokens, text, loss (spans of
    characters) and new_from (the character where the new turns begin).
    """
    return windows_of(counted_turns(conversations, _counter, file), budget, history, section or SECTION * budget)


def _counter(file: str) -> Callable[[list[str]], list[int]]:
    return token_counter(Encoder(file))


def windows_of(counted: DataFrame, budget: int, history: int, section: int) -> DataFrame:
    """``windows`` of turns whose tokens are counted."""
    if not 0 <= history < budget <= section:
        raise ValueError("history must be less than the budget, and a section at least the budget")
    turns = stored(
        counted.withColumns(
            {
                "key": F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
                "tie": F.md5("text"),
                "line": F.monotonically_increasing_id(),
            }
        )
    )
    spots = stored(sections_of(turns, section, history, budget // 2))
    # Rows that are nothing but turns of section 0 have no spot; the others have one per use.
    starts = spots.filter("use = 2").select("line", F.lit(True).alias("moved")).distinct()
    kept = turns.join(starts, "line", "left_anti").select(
        "key", "conv_id", "turn", "role", "tie", "line", "text", "tokens",
        F.lit(0).cast("long").alias("section"), F.lit(2).alias("use"),
    )
    copied = turns.join(spots, "line").select(*kept.columns)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "section", "window", "n_tokens", "text", "loss", "new_from"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.int32()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        held: list[tuple] = []
        size = 0
        rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        for (_, number), group in groupby(rows, key=lambda r: (r[0], r[1])):
            group = list(group)
            system = group.pop(0) if group[0][2] == 0 else None
            first = sum(r[2] == 1 for r in group)
            if first == len(group):
                continue
            tokens = np.array([r[6] for r in group], np.int64)
            inside = system is None and not number and group[0][4] == "system" and group[0][6] <= budget // 2
            if inside:
                system = group[0]
            ahead = system[6] if system else 0
            for i, (back, start, end, repeated) in enumerate(spans(tokens, first, ahead, budget, history, inside)):
                before = [system] * repeated + group[back:start]
                text, loss, fresh = write_window(
                    [(r[4], r[5]) for r in before], [(r[4], r[5]) for r in group[start:end]]
                )
                used = int(tokens[back:end].sum()) + ahead * repeated
                held.append((group[0][3], number, i, used, text, [{"start": a, "end": z} for a, z in loss], fresh))
                size += len(text)
                if size > 4_000_000:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)

    return (
        kept.unionByName(copied)
        .repartition("key", "section")
        .sortWithinPartitions("key", "section", "use", "turn", "role", "tie", "line")
        .select("key", "section", "use", "conv_id", "role", "text", "tokens")
        .mapInArrow(write, WINDOW_TYPE)
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation what its windows say: turns, loss and sizes, with digests.

    A SHA-256 over a whole conversation goes along it; windows are read one by one, so a
    task holds one of them at a time.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        found = []
        for conv_id, group in groupby(rows, key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, text, masked, fresh in group:
                chars += len(text)
                for role, body in parse(text, fresh):
                    n_turns += 1
                    turns.update(f"{role}\n{body}\n".encode())
                for span in masked:
                    body = unescape(text[span["start"] : span["end"]])
                    loss_chars += len(body)
                    loss.update(body.encode())
            found.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(found) == 10_000:
                yield _digest_batch(found)
                found = []
        if found:
            yield _digest_batch(found)

    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "section", "window")
        .select("conv_id", "text", "loss", "new_from")
        .mapInArrow(digested, ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in DIGESTS))
    )


DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _digest_batch(found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.string() if "sha" in n else pa.int64()) for n, c in zip(DIGESTS, zip(*found))]
    return pa.RecordBatch.from_arrays(columns, DIGESTS)
