"""LM scoring: context-tree weighting over bytes, beside a word model as base.

A text, A-Z lower-cased, is coded byte by byte and ended by 0xFF, which UTF-8 never
holds; every byte is eight binary decisions.  The counts of each decision after each
context of 0 to ``DEPTH`` bytes give Krichevsky-Trofimov estimates, and the weighting
mixes them over all depths.  The tree keeps every context of the texts learned from.

Counts are taken by every task over its texts and merged by shuffles.  The subtrees below
the contexts of two bytes are weighed side by side, each whole in one task; only depth 0
and 1, at most 256 contexts, are weighed in the driver.  Frequent grams, at most
``carried`` of them, travel with the tasks that score; all others are joined, and those
never learned are weighed in the same tree with a count of zero, so every score is that
of the whole tree.  Scoring mixes no further learning in, so the score of a text depends
on nothing but the text.

The base is a unigram word model.  Frequent words, at most ``head`` of them, travel
with the tasks; the counts of all other words are joined.

Null and empty texts are one end token.  With nothing to learn from, all estimates
are uniform and the base score has V = N = 0.  A null id is in fold 0, so held out.
Rows with one id are scored apart; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import fold, pieces_of, same, share, shared_value, stored

DEPTH = 5
EDGE = b"\xff"
#: The end of a text, as a token; words hold no space.
END = b" "
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes worked on at a time, and distinct grams a task holds before it hands them on.
AT_ONCE, HELD = 250_000, 1_500_000
#: Depth whose subtrees are weighed whole in one task, and grams weighed at a time.
CUT, WEIGHED = 2, 50_000


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _joined(raw: np.ndarray) -> np.ndarray:
    """Every byte from the ``DEPTH``-th on, below the ``DEPTH`` bytes before it."""
    out = np.zeros(max(len(raw) - DEPTH, 0), np.uint64)
    for back in range(DEPTH + 1):
        out |= raw[DEPTH - back : len(raw) - back].astype(np.uint64) << np.uint64(8 * back)
    return out


def parts_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, int, bool]]:
    """Grams of the texts in arrays of bounded size: (grams, texts that end in it, whether one goes on).

    Short texts share an array; a long one has several of its own, which overlap by
    ``DEPTH`` bytes of context.
    """
    held: list[bytes] = []
    size = 0
    for text in [*texts, None]:
        if held and (text is None or size + len(text) > AT_ONCE):
            yield grams(held)[0], len(held), False
            held, size = [], 0
        if text is None:
            break
        if len(text) <= AT_ONCE:
            held.append(text)
            size += len(text)
            continue
        raw = np.frombuffer(EDGE * DEPTH + text + EDGE, np.uint8)
        for at in range(0, len(text) + 1, AT_ONCE):
            last = at + AT_ONCE >= len(text) + 1
            yield _joined(raw[at : at + AT_ONCE + DEPTH]), int(last), not last


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every coded byte of all texts, itself below the ``DEPTH`` bytes before it; and the first of each text."""
    data = b"".join([EDGE * DEPTH + t + EDGE for t in texts])
    raw = np.frombuffer(data, np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    out = _joined(raw)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    keep = np.ones(len(out), bool)
    for i in range(DEPTH):
        at = starts + np.arange(len(starts)) * DEPTH - DEPTH + i
        keep[at[at >= 0]] = False
    return out[keep], starts


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (kind 0, by their bytes) and byte grams (kind 1, by their number), counted within the task."""
    words: Counter = Counter()
    n_texts = 0
    known, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def flush_words():
        names = list(words)
        for a in range(0, len(names), 50_000):
            part = names[a : a + 50_000]
            yield batch([0] * len(part), part, [0] * len(part), [words[w] for w in part])
        words.clear()

    def batch(kind, word, gram, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(word, pa.binary()), pa.array(gram, pa.int64()), pa.array(n, pa.int64())],
            ["kind", "word", "gram", "n"],
        )

    def flush_grams():
        nonlocal known, times
        for a in range(0, len(known), 50_000):
            part = known[a : a + 50_000]
            yield batch(np.ones(len(part), np.int32), [b""] * len(part), part.view(np.int64), times[a : a + 50_000])
        known, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge():
        nonlocal known, times, late, late_size
        keys, weight = np.concatenate([known, *[k for k, _ in late]]), np.concatenate([times, *[n for _, n in late]])
        order = np.argsort(keys, kind="stable")
        keys, weight = keys[order], weight[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        known, times = keys[first], np.add.reduceat(weight, first) if len(first) else weight
        late, late_size = [], 0

    late: list[tuple[np.ndarray, np.ndarray]] = []
    late_size = 0
    for b in batches:
        for part in pieces_of(b.column(0), AT_ONCE):
            texts = [lowered(t) for t in part]
            for t in texts:
                words.update(t.split())
            n_texts += len(texts)
            for found, _, _ in parts_of(texts):
                late.append(np.unique(found, return_counts=True))
                late_size += len(late[-1][0])
                if late_size > HELD // 3:
                    merge()
                if len(known) > HELD:
                    yield from flush_grams()
            if len(words) > 200_000:
                yield from flush_words()
    merge()
    if n_texts:
        words[END] += n_texts
        yield from flush_words()
    yield from flush_grams()


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Natural log of gamma for x > 0, by Stirling's series after a shift by eight."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) - shift


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the KT probability of so many zeros and ones, in any order."""
    out = np.zeros(zeros.shape)
    at = np.nonzero(zeros + ones)
    a, b = zeros[at].astype(float), ones[at].astype(float)
    out[at] = _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1) - math.log(math.pi)
    return out


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 255 inner nodes of the byte tree (heap order), from counts by byte."""
    zeros, ones = [], []
    level = counts
    while level.shape[1] > 1:
        zeros.append(level[:, 0::2])
        ones.append(level[:, 1::2])
        level = level[:, 0::2] + level[:, 1::2]
    return np.concatenate(zeros[::-1], axis=1), np.concatenate(ones[::-1], axis=1)


def _log_bytes(p_one: np.ndarray) -> np.ndarray:
    """log10 probability of every byte from those of a one at the 255 nodes."""
    out = np.zeros((len(p_one), 1))
    for bit in range(8):
        p = p_one[:, (1 << bit) - 1 : (2 << bit) - 1]
        out = np.stack([out + np.log10(1 - p), out + np.log10(p)], axis=2).reshape(len(p), -1)
    return out


def weigh(nodes: list[dict[int, int]], counts: list[np.ndarray]) -> np.ndarray:
    """log10 probabilities of the bytes after each kept context, rows in the order of depth, then number.

    For trees that fit one process, where contexts may be left out; ``Subtrees`` weighs whole ones.

    ``nodes[d]`` numbers the kept contexts of d bytes, ``counts[d]`` has their byte counts.
    From the deepest up, the probability of what a node has seen is half its own estimate
    and half the product of those below it; from the root down, that ratio is the weight
    with which a node speaks for itself.
    """
    depths = len(nodes)
    own, ratio = [None] * depths, [None] * depths
    rest: list = [None] * depths
    below = None
    for d in reversed(range(depths)):
        zeros, ones = _decisions(counts[d])
        own[d] = ((ones + 0.5) / (zeros + ones + 1)).astype(np.float32)
        alone = _kt(zeros, ones)
        if d == DEPTH:
            weighted = alone
            ratio[d] = np.ones(alone.shape, np.float32)
        else:
            covered = np.zeros_like(counts[d])
            split = np.zeros(alone.shape)
            if below is not None and len(nodes[d + 1]):
                mask = (1 << 8 * d) - 1
                parents = np.array([nodes[d][c & mask] for c in nodes[d + 1]])
                np.add.at(covered, parents, counts[d + 1])
                np.add.at(split, parents, below)
            left0, left1 = _decisions(counts[d] - covered)
            split += _kt(left0, left1)
            rest[d] = ((left1 + 0.5) / (left0 + left1 + 1)).astype(np.float32)
            weighted = np.logaddexp(alone, split) - math.log(2)
            ratio[d] = np.exp(alone - math.log(2) - weighted).astype(np.float32)
        below = weighted
    out, said, unsaid = [], None, None
    for d in range(depths):
        if d == 0:
            said, unsaid = np.zeros_like(own[0]), np.ones_like(own[0])
        else:
            mask = (1 << 8 * (d - 1)) - 1
            parents = np.array([nodes[d - 1][c & mask] for c in nodes[d]], int)
            said, unsaid = said[parents], unsaid[parents]
        said = said + unsaid * ratio[d] * own[d]
        unsaid = unsaid * (1 - ratio[d])
        p = said if rest[d] is None else said + unsaid * rest[d]
        out.append(_log_bytes(np.clip(p.astype(float), 1e-9, 1 - 1e-9)).astype(np.float32))
        own[d] = ratio[d] = rest[d] = None
    return np.concatenate(out)


class Subtrees:
    """The tree below contexts of ``CUT`` bytes, over some grams: all those of each such context.

    Grams are sorted along their paths, latest byte first, so that what shares a context
    lies together.  The eight decisions of a byte are weighed one after the other.
    """

    def __init__(self, grams: np.ndarray, n: np.ndarray) -> None:
        path = np.zeros(len(grams), np.uint64)
        for back in range(1, DEPTH + 1):
            path = path << np.uint64(8) | grams >> np.uint64(8 * back) & np.uint64(255)
        keys = path << np.uint64(8) | grams & np.uint64(255)
        self.order = np.argsort(keys, kind="stable")
        #: By depth: sorted contexts above their next byte, counts, and the place of each in the depth above.
        self.keys, self.n = {DEPTH: keys[self.order]}, {DEPTH: n[self.order].astype(float)}
        self.above: dict[int, np.ndarray] = {}
        for d in range(DEPTH - 1, CUT - 1, -1):
            longer = self.keys[d + 1]
            shorter = longer >> np.uint64(16) << np.uint64(8) | longer & np.uint64(255)
            self.keys[d], self.above[d + 1] = np.unique(shorter, return_inverse=True)
            self.n[d] = np.bincount(self.above[d + 1], self.n[d + 1], len(self.keys[d]))

    def _weigh(self, bit: int):
        """By depth: the node of each gram, each node's first gram, its own estimate, weight and ratio; from the deepest up."""
        out, below = {}, None
        for d in range(DEPTH, CUT - 1, -1):
            keys = self.keys[d]
            nodes = keys >> np.uint64(8 - bit)
            new = np.concatenate([[True], nodes[1:] != nodes[:-1]])
            first, node = np.flatnonzero(new), np.cumsum(new) - 1
            one = (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(float)
            ones = np.bincount(node, self.n[d] * one, len(first))
            zeros = np.bincount(node, self.n[d] * (1 - one), len(first))
            alone = _kt(zeros, ones)
            if d == DEPTH:
                weighted, ratio = alone, np.ones(len(first))
            else:
                split = np.bincount(node[self.above[d + 1][out[d + 1][1]]], below, len(first))
                weighted = np.logaddexp(alone, split) - math.log(2)
                ratio = np.exp(alone - math.log(2) - weighted)
            out[d] = (node, first, (ones + 0.5) / (zeros + ones + 1), weighted, ratio)
            below = weighted
        return out

    def sums(self) -> np.ndarray:
        """Weighted log probabilities, added up at the decisions of the contexts of ``CUT`` - 1 = 1 byte: 256 rows."""
        out = np.zeros((256, 255))
        for bit in range(8):
            _, first, _, weighted, _ = self._weigh(bit)[CUT]
            keys = self.keys[CUT][first]
            last = (keys >> np.uint64(16)).astype(np.int64)
            prefix = ((keys & np.uint64(255)) >> np.uint64(8 - bit)).astype(np.int64)
            np.add.at(out, (last, (1 << bit) - 1 + prefix), weighted)
        return out

    def logs(self, said: np.ndarray, unsaid: np.ndarray) -> np.ndarray:
        """log10 probability of the byte of each gram after its context, given what depth 1 has said."""
        out = np.zeros(len(self.order))
        for bit in range(8):
            levels = self._weigh(bit)
            for d in range(CUT, DEPTH + 1):
                node, first, own, _, ratio = levels[d]
                if d == CUT:
                    keys = self.keys[d][first]
                    last = (keys >> np.uint64(16)).astype(np.int64)
                    at = (1 << bit) - 1 + ((keys & np.uint64(255)) >> np.uint64(8 - bit)).astype(np.int64)
                    now, left = said[last, at], unsaid[last, at]
                else:
                    parents = levels[d - 1][0][self.above[d][first]]
                    now, left = now[parents], left[parents]
                now, left = now + left * ratio * own, left * (1 - ratio)
            p = np.clip(now, 1e-9, 1 - 1e-9)[levels[DEPTH][0]]
            one = (self.keys[DEPTH] >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
            out[self.order] += np.log10(np.where(one, p, 1 - p))
        return out


def said_at_one(counts: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What depths 0 and 1 say at each decision, and the weight they leave to longer contexts.

    ``counts`` has the bytes after each single byte, ``below`` the sums of the subtrees.
    """
    own, ratio = [None, None], [None, None]
    split = below
    for d, level in ((1, counts), (0, counts.sum(axis=0, keepdims=True))):
        zeros, ones = _decisions(level)
        alone = _kt(zeros, ones)
        weighted = np.logaddexp(alone, split) - math.log(2)
        own[d], ratio[d] = (ones + 0.5) / (zeros + ones + 1), np.exp(alone - math.log(2) - weighted)
        split = weighted.sum(axis=0, keepdims=True)
    said, unsaid = ratio[0] * own[0], 1 - ratio[0]
    return said + unsaid * ratio[1] * own[1], unsaid * (1 - ratio[1])


def _subtrees(grams: DataFrame, build: Callable[[np.ndarray, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``build`` over the rows (gram, n), some subtrees at a time, every one whole."""
    mask = (1 << 8 * CUT) - 1 << 8

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for b in batches:
            gram, n = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            held.append((gram, n))
            size += len(gram)
            if size <= WEIGHED:
                continue
            gram, n = (np.concatenate(x) for x in zip(*held))
            # The last subtree may go on in the next batch.
            whole = np.flatnonzero((gram & mask) != (gram[-1] & mask))
            end = int(whole[-1]) + 1 if len(whole) else 0
            if end:
                yield from build(gram[:end].view(np.uint64), n[:end])
            held, size = [(gram[end:], n[end:])], len(gram) - end
        if size:
            gram, n = (np.concatenate(x) for x in zip(*held))
            yield from build(gram.view(np.uint64), n)

    cut = F.col("gram").bitwiseAND(F.lit(mask))
    return (
        grams.select("gram", "n", cut.alias("cut"))
        .repartition("cut")
        .sortWithinPartitions("cut")
        .select("gram", "n")
        .mapInArrow(built, schema)
    )


def _sums(gram: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    sums = Subtrees(gram, n).sums()
    last, at = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(last), pa.array(at), pa.array(sums[last, at])], ["last", "at", "below"])


def gram_logs(grams: DataFrame, top, unlearned: bool = False) -> DataFrame:
    """gram, n and log10 probability of every gram, or with ``unlearned`` only of those counted zero times."""

    def build(gram: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        logs = Subtrees(gram, n).logs(*shared_value(top))
        keep = n == 0 if unlearned else np.ones(len(n), bool)
        columns = [gram.view(np.int64)[keep], n[keep], logs[keep]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "n", "log"])

    return _subtrees(grams, build, "gram long, n long, log double")


class Scorer:
    """The weighted tree, and the head of the word counts, ready for look-ups."""

    def __init__(self, keys: np.ndarray, table: np.ndarray, head: dict[bytes, int], most_depth: int) -> None:
        self.table = table.ravel()
        self.head = {w: (math.log10(c + 0.1), c) for w, c in head.items()}
        self.most_depth = most_depth
        # Open addressing: key of a context is its depth above its bytes.
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.slots = np.full(1 << self.bits, EMPTY, np.uint64)
        self.rows = np.zeros(1 << self.bits, np.int32)
        at, todo = self.slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.slots[at] == EMPTY
            self.slots[at[free]] = keys[todo[free]]
            done = self.slots[at] == keys[todo]
            self.rows[at[done]] = todo[done]
            at, todo = (at[~done] + 1) & (len(self.slots) - 1), todo[~done]

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of the contexts, -1 where not kept."""
        at = self.slot(keys)
        found = self.slots[at]
        out = np.where(found == keys, self.rows[at], -1)
        open_ = np.flatnonzero((found != keys) & (found != EMPTY))
        at = at[open_]
        while len(open_):
            at = (at + 1) & (len(self.slots) - 1)
            wanted, found = keys[open_], self.slots[at]
            hit = found == wanted
            out[open_[hit]] = self.rows[at[hit]]
            go = ~hit & (found != EMPTY)
            open_, at = open_[go], at[go]
        return out

    def _of_bytes(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of every coded byte after the longest context kept."""
        byte = (keys & np.uint64(255)).astype(np.int64)
        context = keys >> np.uint64(8)
        row = np.zeros(len(keys), np.int64)
        todo = np.arange(len(keys))
        for depth in range(self.most_depth, 0, -1):
            mask = np.uint64((1 << 8 * depth) - 1)
            got = self.find((context[todo] & mask) | np.uint64(depth << 56))
            row[todo[got >= 0]] = got[got >= 0]
            todo = todo[got < 0]
        return self.table[row * 256 + byte].astype(float)

    def logs(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text with its end."""
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        out = np.zeros(len(texts))
        at = 0
        for keys, ended, goes_on in parts_of(texts):
            logs = self._of_bytes(keys)
            if goes_on or ended == 1:
                out[at] += logs.sum()
            else:
                starts = np.concatenate([[0], np.cumsum(sizes[at : at + ended])])[:-1]
                out[at : at + ended] = np.add.reduceat(logs, starts)
            at += ended
        return out


class GramScorer(Scorer):
    """The frequent grams with their log10 probabilities, and the head of the word counts."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray, head: dict[bytes, int]) -> None:
        super().__init__(grams, logs, head, 0)

    def logs_and_rest(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By text: the log10 probability of its frequent grams; and all others: text, gram, how often."""
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        out = np.zeros(len(texts))
        owners, rest = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        at = 0
        for grams, ended, goes_on in parts_of(texts):
            several = not goes_on and ended > 1
            owner = np.repeat(np.arange(at, at + ended), sizes[at : at + ended]) if several else np.full(len(grams), at)
            row = self.find(grams)
            found = row >= 0
            out += np.bincount(owner[found], self.table[row[found]], len(texts))
            owners.append(owner[~found])
            rest.append(grams[~found])
            at += ended
        owner, gram = np.concatenate(owners), np.concatenate(rest)
        order = np.lexsort((gram, owner))
        owner, gram = owner[order], gram[order]
        new = np.ones(len(gram), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (gram[1:] != gram[:-1])
        first = np.flatnonzero(new)
        return out, owner[first], gram[first], np.diff(np.append(first, len(gram)))


@dataclass
class LanguageModel:
    scorer: GramScorer
    tail: DataFrame  # word, n: all learned words that are not in the scorer's head
    n_tokens: int
    n_distinct: int
    grams: DataFrame  # gram, n and log10 probability of all learned grams
    top: Broadcast  # what depths 0 and 1 say


def _least_count(counted: DataFrame, column: str, most: int) -> int:
    """The smallest bound on a count that at most ``most`` rows reach, to a few percent, from a histogram."""
    step = F.when(F.col(column) < 64, F.col(column)).otherwise(F.floor(64 + 16 * F.log2(F.col(column) / 64)))
    cells = counted.groupBy(step.cast("int").alias("step")).agg(F.count("*").alias("n"), F.min(column).alias("low")).collect()
    total, bound = 0, None
    for cell in sorted(cells, key=lambda c: -c["step"]):
        total += cell["n"]
        if total > most:
            break
        bound = cell["low"]
    return bound if bound is not None else (1 << 62)


def fit(docs: DataFrame, carried: int = 500_000, head: int = 100_000) -> LanguageModel:
    """Learns both models from all rows of ``docs``; ``carried`` and ``head`` bound what travels, not what counts."""
    spark = docs.sparkSession
    counted = stored(
        docs.select("text")
        .mapInArrow(count_batches, "kind int, word binary, gram long, n long")
        .groupBy("kind", "word", "gram")
        .agg(F.sum("n").alias("n"))
    )
    words = counted.filter("kind = 0").select("word", "n")
    n_tokens, n_distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    low_word = _least_count(words, "n", head)
    heads = {bytes(r["word"]): r["n"] for r in words.filter(F.col("n") >= low_word).collect()}

    grams = counted.filter("kind = 1").select("gram", "n")
    # At most 256 contexts of one byte: 256 bytes and 255 decisions each.
    counts, below = np.zeros((256, 256), np.int64), np.zeros((256, 255))
    for r in grams.groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("pair")).agg(F.sum("n").alias("n")).collect():
        counts[r["pair"] >> 8, r["pair"] & 255] = r["n"]
    sums = _subtrees(grams, _sums, "last long, at long, below double")
    for r in sums.groupBy("last", "at").agg(F.sum("below").alias("below")).collect():
        below[r["last"], r["at"]] = r["below"]
    top = share(spark, same, said_at_one(counts, below))
    logs = stored(gram_logs(grams, top))
    # At most ``carried`` rows of two numbers.
    often = logs.filter(F.col("n") >= _least_count(logs, "n", carried)).select("gram", "log").toArrow()
    keys = often.column("gram").to_numpy().view(np.uint64)
    scorer = GramScorer(keys, often.column("log").to_numpy(), heads)
    return LanguageModel(scorer, words.filter(F.col("n") < low_word), n_tokens, n_distinct, logs, top)


SCORED = (
    "n_tokens long, n_known long, base double, carried double, n_bytes long, tail array<binary>, times array<int>, "
    "grams array<long>, gram_times array<long>"
)


def score(docs: DataFrame, model: LanguageModel, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row."""
    shared = share(docs.sparkSession, same, model.scorer)
    unseen = math.log10(0.1)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared_value(shared)
        head = scorer.head
        for b in batches:
            ids, texts, at = b.column(0), b.column(1), 0
            for part in pieces_of(texts, AT_ONCE):
                raw = [lowered(t) for t in part]
                logs, owner, rest, rest_times = scorer.logs_and_rest(raw)
                cuts = pa.array(np.searchsorted(owner, np.arange(len(raw) + 1)), pa.int32())
                rows = []
                for t, log in zip(raw, logs.tolist()):
                    words = t.split()
                    words.append(END)
                    found = [x for x in map(head.get, words) if x is not None]
                    tail = Counter([w for w in words if w not in head]) if len(found) < len(words) else {}
                    rows.append(
                        (
                            len(words),
                            len(found),
                            sum([x[0] for x in found]) + unseen * (len(words) - len(found)),
                            log,
                            len(t) + 1,
                            list(tail),
                            list(tail.values()),
                        )
                    )
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
                columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (rest.view(np.int64), rest_times)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), *columns, *lists],
                    ["doc_id", "n_tokens", "n_known", "base", "carried", "n_bytes", "tail", "times", "grams", "gram_times"],
                )
                at += len(part)

    rows = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(scored, "doc_id long, " + SCORED)
        # Given while the rows are written, and from then on fixed.
        .withColumn("row", F.monotonically_increasing_id())
    )
    more = (
        rows.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t"))
        .select("row", F.col("t.tail").alias("word"), F.col("t.times").alias("times"))
        .join(model.tail, "word")
        .groupBy("row")
        .agg(
            F.sum("times").alias("more_known"),
            F.sum(F.col("times") * (F.log10(F.col("n") + 0.1) - unseen)).alias("more_base"),
        )
    )
    rest = rows.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("t")).select(
        "row", F.col("t.grams").alias("gram"), F.col("t.gram_times").alias("times")
    )
    learned = model.grams.select("gram", "n")
    new = rest.select("gram").distinct().join(learned, "gram", "left_anti").select("gram", F.lit(0).cast("long").alias("n"))
    logs = model.grams.unionByName(gram_logs(learned.unionByName(new), model.top, unlearned=True))
    rare = rest.join(logs, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("rare"))
    floor = math.log10(model.n_tokens + 0.1 * (model.n_distinct + 1))
    whole = F.col("carried") + F.coalesce("rare", F.lit(0.0))
    out = rows.drop("tail", "times", "grams", "gram_times").join(more, "row", "left").join(rare, "row", "left")
    return out.select(
        "doc_id",
        (fold("doc_id", folds) == 0).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"),
        whole.alias("score"),
        (-whole / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
