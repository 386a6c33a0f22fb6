"""How far the sources of a language differ in their words, over run-length columns.

Words are counted per (lang, source) in the tasks that read the texts.  The words kept
in a language make up the rows of a table with one column of counts per source and one
for the language.  Its rows are ordered by their counts, sources with few distinct
words first, so that equal counts lie together; the order is cut into blocks, and in a
block every column is held as runs of equal counts.  The difference of two columns is
read from their runs: the borders of both are intersected, and the difference of the
two shares in a segment is multiplied by the segment's length.  Blocks add up.

A share is ``1 + floor(10^9 (count + 5) / (N + 5 V))``, in whole numbers throughout;
counts are Python's when a share is made of them, so they cannot overflow.

Null text, lang and source are empty strings.  Every row is a document, repeated or
not, and equal values are ranked by their item in UTF-8 order.  A text of any length is
read in parts.  A group without terms and a language without kept terms have rows of
value 0.  An empty table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored

#: Fixed values of the shares.
SCALE, PRIOR = 1_000_000_000, 5
#: Distinct words a task holds before it hands its counts on, and bytes of a text read at a time.
HELD, PART = 300_000, 1 << 20
#: Counts a block may hold; its number of words follows from the widest language, 4096 at most.
CELLS = 1 << 20

#: A-Z become small letters, other ASCII signs but letters become spaces, bytes above 127 stay.
TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
KEYS = "lang string, source string, term string"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in parts of bounded size that cut no term."""
    text = text.translate(TERMS)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PART)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with the term).

    Every (lang, source) also has a row of the empty term, with its number of documents.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[tuple[bytes, bytes], Counter] = {}
        within: dict[tuple[bytes, bytes], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in times.items():
                having = within[lang, source]
                # The empty term is in every document, so ``having`` has all keys.
                words = list(having)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(words), pa.binary()).cast(pa.string()),
                        pa.array([source] * len(words), pa.binary()).cast(pa.string()),
                        pa.array(words, pa.binary()).cast(pa.string()),
                        pa.array([found[w] for w in words], pa.int64()),
                        pa.array([having[w] for w in words], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
            times.clear()
            within.clear()

        held = 0
        for b in batches:
            for lang, source, text in zip(*[c.cast(pa.binary()).to_pylist() for c in b.columns]):
                group = lang or b"", source or b""
                if group not in times:
                    times[group], within[group] = Counter(), Counter()
                found, having = times[group], within[group]
                before, seen = len(having), {b""}
                for words in terms_of(text or b""):
                    found.update(words)
                    seen.update(words)
                having.update(seen)
                held += len(having) - before
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = docs.select("lang", "source", "text").mapInArrow(counted, KEYS + ", n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """The share of each count; counts repeat, so each distinct one is worked out once, exactly."""
    distinct, which = np.unique(counts, return_inverse=True)
    return np.array([1 + SCALE * (c + PRIOR) // (n + PRIOR * v) for c in distinct.tolist()], np.int64)[which]


class Runs:
    """A column of a block as runs: where each starts, its count and its share."""

    def __init__(self, places: np.ndarray, counts: np.ndarray, n: int, v: int) -> None:
        """``places`` ascend; places not named count 0."""
        starts = np.unique(np.concatenate([[0], places, places + 1]))
        value = np.zeros(len(starts), np.int64)
        value[np.searchsorted(starts, places)] = counts
        first = np.concatenate([[True], value[1:] != value[:-1]])
        self.starts, self.counts = starts[first], value[first]
        self.shares = shares(self.counts, n, v)

    def at(self, places: np.ndarray) -> np.ndarray:
        """Number of the run each place lies in."""
        return np.searchsorted(self.starts, places, "right") - 1


def intersect(a: Runs, b: Runs, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of the segments cut by both borders, and the runs they lie in."""
    starts = np.union1d(a.starts, b.starts)
    starts = starts[starts < size]
    return starts, np.diff(np.append(starts, size)), a.at(starts), b.at(starts)


def difference(a: Runs, b: Runs, size: int) -> int:
    _, lengths, in_a, in_b = intersect(a, b, size)
    return int((np.abs(a.shares[in_a] - b.shares[in_b]) * lengths).sum())


def risen(group: Runs, whole: Runs, terms: list[bytes], top: int) -> list[tuple[bytes, int]]:
    """The ``top`` terms of the block whose share in the group is furthest above the language's."""
    starts, lengths, in_group, in_whole = intersect(group, whole, len(terms))
    rise = group.shares[in_group] - whole.shares[in_whole]
    good = np.flatnonzero((rise > 0) & (group.counts[in_group] > 0))
    good = good[np.argsort(-rise[good], kind="stable")]
    # Whole segments in falling order of the rise, as many as hold ``top`` terms, and those tied with the last.
    enough = np.searchsorted(np.cumsum(lengths[good]), top)
    if enough < len(good):
        good = good[rise[good] >= rise[good[enough]]]
    found = [
        (terms[place], int(rise[s]))
        for s in good.tolist()
        for place in range(starts[s], starts[s] + lengths[s])
    ]
    return sorted(found, key=lambda f: (-f[1], f[0]))[:top]


FOUND = pa.schema([*[(c, pa.string()) for c in ("lang", "part", "source", "item")], ("value", pa.int64())])


def block_differences(lang: str, rows: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Differences of all pairs of groups over one block, and the risen terms of each group.

    ``rows`` holds place, term, total, source and n of the counts above 0.
    """
    place, counts = (rows.column(c).to_numpy() for c in ("place", "n"))
    places, first, place = np.unique(place, return_index=True, return_inverse=True)
    size = len(places)
    taken = rows.select(["term", "total"]).take(pa.array(first))
    terms = [t.encode() for t in taken.column("term").to_pylist()]
    sizes = groups.to_pylist()
    whole = Runs(np.arange(size), taken.column("total").to_numpy(), sizes[0]["whole_n"], sizes[0]["v"])

    named = rows.column("source").combine_chunks().dictionary_encode()
    source = named.indices.to_numpy()
    order = np.lexsort((place, source))
    edges = np.searchsorted(source[order], np.arange(len(named.dictionary) + 1))
    of_source = {s: order[a:z] for s, a, z in zip(named.dictionary.to_pylist(), edges, edges[1:])}
    columns = []
    for group in sizes:
        own = of_source.get(group["source"], order[:0])
        columns.append((group["source"], Runs(place[own], counts[own], group["n"], group["v"])))

    out = []
    for i, (name, runs) in enumerate(columns):
        for other, others in columns[:i]:
            out.append(("pair", *sorted((name, other)), difference(runs, others, size)))
        out += [("term", name, term.decode(), rise) for term, rise in risen(runs, whole, terms, top)]
    return pa.Table.from_pylist([dict(zip(FOUND.names, (lang, *row))) for row in out], schema=FOUND)


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value and rank, as told at the top.

    Part ``pair``: the difference to each other source of the language, summed over all
    kept terms.  Part ``term``: the ``top`` terms used more in the source than in its
    language.
    """
    counts = stored(term_counts(docs))
    markers = counts.filter("term = ''").select("lang", "source")
    # One entry per source of a language, so as wide as the groups of the result.
    kept = stored(
        counts.filter("term != ''")
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("entries"),
        )
        .filter(F.col("docs") >= least_docs)
        .drop("docs")
    )
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("whole_n"))
    by_group = (
        kept.select("lang", F.inline("entries"))
        .groupBy("lang", "source")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
    )
    groups = stored(
        markers.join(by_group, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "kinds", "v", "whole_n")])
    )

    widest = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    block = min(4096, 1 << max(CELLS // widest, 1).bit_length() - 1)

    # Equal counts lie together: rows ordered by their counts, sources with few words leading.
    leading = (
        kept.select("lang", "term", "total", F.inline("entries"))
        .join(groups.select("lang", "source", "kinds"), ["lang", "source"])
        .groupBy("lang", "term", "total")
        .agg(F.sort_array(F.collect_list(F.struct("kinds", "source", "n"))).alias("entries"))
    )
    placed = stored(
        leading.repartitionByRange("lang", "entries", "term")
        .sortWithinPartitions("lang", "entries", "term")
        .withColumn("at", F.monotonically_increasing_id())
        # The row's number in its range holds 33 bits; what lies above them is the range.
        .withColumn("block", F.expr(f"at div {block}"))
    )
    blocks = placed.select("lang", "block").distinct().join(groups.drop("kinds"), "lang")
    # Columns of their own: both sides of the cogroup come from ``placed``.
    blocks = blocks.select(*[F.col(c).alias(c) for c in blocks.columns])
    rows = placed.select("lang", "block", F.col("at").alias("place"), "term", "total", F.inline("entries")).drop("kinds")

    def compare(key, rows: pa.Table, groups: pa.Table) -> pa.Table:
        if not rows.num_rows or not groups.num_rows:
            return FOUND.empty_table()
        return block_differences(key[0].as_py(), rows, groups, top)

    found = stored(
        rows.groupBy("lang", "block")
        .cogroup(blocks.groupBy("lang", "block"))
        .applyInArrow(compare, "lang string, part string, source string, item string, value long")
        .groupBy("lang", "part", "source", "item")
        .agg(F.sum("value").alias("value"))
    )

    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").filter("source != item")
    value = found.filter("part = 'pair'").select(
        "lang", F.col("source").alias("a"), F.col("item").alias("b"), "value"
    )
    pairs = (
        pairs.withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")})
        .join(value, ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    terms = found.filter("part = 'term'").select("lang", "source", "part", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= top))
