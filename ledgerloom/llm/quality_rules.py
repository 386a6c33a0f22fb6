"""Quality rules: an ordered decision list learned from labelled documents.

Sequential covering as in RIPPER: a rule for bad documents is grown condition by
condition on two thirds of the rows still uncovered, cut back on the other third,
and kept while it is precise there.  The list becomes one Spark conditional
expression over the statistics of a document.

Null and empty texts have zero statistics and fail the base rule.  Rows repeat
as they come, ties of the sample are broken by id, an empty or unlabelled table
learns no rule and keeps what passes the base rule.  Other columns of the
documents are carried along untouched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import CAPITALS, DIGITS, SPACES

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_capitals",
    "n_digits",
    "n_stops",
    "n_marks",
)
STATISTICS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of ``width`` words found twice or more, first included."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    covered = end = 0
    for at, window in enumerate(windows):
        if often[window] > 1:
            covered += at + width - max(at, end)
            end = at + width
    return covered


def statistics(text: str) -> tuple[int, ...]:
    """The figures named in ``COUNTS`` of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - without(SPACES),
        without(SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        without(CAPITALS),
        without(DIGITS),
        without(b".,;:"),
        without(b"!?"),
    )


def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = [statistics(text or "") for text in texts.to_pylist()]
        columns = list(zip(*rows)) if rows else [()] * len(COUNTS)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(COUNTS))


def document_statistics(text: str) -> Column:
    return F.arrow_udf(_statistics, STATISTICS_TYPE)(text)


def shares(s: str) -> dict[str, Column]:
    """The learned-on ratios, from a column ``s`` of statistics."""
    words = F.greatest(F.col(f"{s}.n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col(f"{s}.word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col(f"{s}.n_lines"), F.lit(1)).cast("double")
    return {
        "symbols_per_char": F.col(f"{s}.n_symbols") / chars,
        "symbols_per_word": F.col(f"{s}.n_symbols") / words,
        "capitals_per_char": F.col(f"{s}.n_capitals") / chars,
        "digits_per_char": F.col(f"{s}.n_digits") / chars,
        "stops_per_word": F.col(f"{s}.n_stops") / words,
        "marks_per_word": F.col(f"{s}.n_marks") / words,
        "distinct_share": F.col(f"{s}.n_distinct") / words,
        "repeat_share": F.col(f"{s}.n_repeat_words") / words,
        "dup_line_share": F.col(f"{s}.n_dup_lines") / lines,
        "chars_per_word": F.col(f"{s}.word_chars") / words,
        "n_words": F.col(f"{s}.n_words").cast("double"),
    }


def base_failed(s: str) -> Column:
    n, repeats = F.col(f"{s}.n_words"), F.col(f"{s}.n_repeat_words")
    return (n < 10) | (100 * repeats > 20 * n)


@dataclass(frozen=True)
class Condition:
    figure: str
    above: bool
    bound: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values > self.bound if self.above else values <= self.bound

    def column(self, figures: dict[str, Column]) -> Column:
        col = figures[self.figure]
        return col > self.bound if self.above else col <= self.bound

    def __str__(self) -> str:
        return f"{self.figure} {'>' if self.above else '<='} {self.bound:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules for bad documents, in order; what none of them covers is good."""

    rules: tuple[tuple[Condition, ...], ...]

    def verdict(self, s: str) -> Column:
        figures = shares(s)
        out = None
        for rule in self.rules:
            when = F.lit(True)
            for condition in rule:
                when = when & condition.column(figures)
            out = F.when(when, False) if out is None else out.when(when, False)
        return F.lit(True) if out is None else out.otherwise(True)

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, rule)) + " -> bad" for rule in self.rules)


def _covered(rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x[:, names.index(c.figure)])
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], longest: int) -> list[Condition]:
    """Adds the condition of highest information gain until only bad rows are left."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < longest:
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        if not p or not n:
            break
        before, best, gain = np.log2(p / (p + n)), None, 1e-9
        for j, name in enumerate(names):
            values = x[inside, j]
            bounds = np.unique(np.quantile(values, np.linspace(0, 1, 65)[1:-1]))
            cells = np.searchsorted(bounds, values, side="left")
            hit = np.bincount(cells, bad[inside], len(bounds) + 1).cumsum()[:-1]
            all_ = np.bincount(cells, minlength=len(bounds) + 1).cumsum()[:-1]
            for above, good_p, good_n in ((False, hit, all_), (True, p - hit, p + n - all_)):
                score = good_p * (np.log2(np.maximum(good_p, 1e-9) / np.maximum(good_n, 1)) - before)
                at = int(score.argmax())
                if score[at] > gain:
                    gain, best = score[at], Condition(name, above, float(bounds[at]))
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x[:, names.index(best.figure)])
    return rule


def _prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray, names: list[str]) -> list[Condition]:
    """Drops last conditions while that does not lower (p - n) / (p + n) on the other rows."""

    def worth(r) -> float:
        inside = _covered(r, x, names)
        p, n = (bad & inside).sum(), (~bad & inside).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn_list(
    x: np.ndarray,
    bad: np.ndarray,
    names: list[str],
    max_rules: int = 24,
    longest: int = 5,
    precision: float = 0.9,
    least: int = 3,
) -> DecisionList:
    """Sequential covering; a rule needs ``precision`` and ``least`` bad rows among the pruning rows."""
    rules: list[tuple[Condition, ...]] = []
    left = np.ones(len(x), bool)
    part = np.arange(len(x)) % 3
    while len(rules) < max_rules:
        grow, prune = left & (part != 2), left & (part == 2)
        if bad[grow].sum() < least or not prune.any():
            break
        rule = _grow(x[grow], bad[grow], names, longest)
        if not rule:
            break
        rule = _prune(rule, x[prune], bad[prune], names)
        inside = _covered(rule, x, names)
        hits, all_ = (bad & prune & inside).sum(), (prune & inside).sum()
        if hits < least or hits < precision * all_:
            break
        rules.append(tuple(rule))
        left &= ~inside
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DecisionList:
    """Learns from at most ``sample`` labelled ids, taken in the order of their hash."""
    marked = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(sample)
    )
    figures = shares("s")
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(marked), "doc_id")
        .select("doc_id", "quality", document_statistics("text").alias("s"))
        .select("doc_id", "quality", *[c.alias(n) for n, c in figures.items()])
        .toPandas()
        .sort_values(["doc_id", "quality", *figures], ignore_index=True)
    )
    # The parts for growing and pruning follow the hash, not the id.
    rows = rows.sample(frac=1, random_state=0, ignore_index=True)
    return learn_list(rows[list(figures)].to_numpy(float), (rows["quality"] == 0).to_numpy(), list(figures))


def judge(docs: DataFrame, rules: DecisionList, name: str = "quality_rules") -> DataFrame:
    """``docs`` with a column ``name``: statistics, base_failed and kept."""
    held = f"_{name}_statistics"
    out = docs.withColumn(held, document_statistics("text"))
    return out.withColumn(
        name,
        F.struct(
            *[F.col(f"{held}.{c}").alias(c) for c in COUNTS],
            base_failed(held).alias("base_failed"),
            (~base_failed(held) & rules.verdict(held)).alias("kept"),
        ),
    ).drop(held)
