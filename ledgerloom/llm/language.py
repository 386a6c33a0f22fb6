"""Language of a text by cross-parsing against labelled text.

Per language a suffix automaton is built over a bounded sample of labelled text.
A text is parsed into the fewest phrases that each occur in that sample, always
taking the longest match.  The language whose phrases, times the bits it takes to
point into its sample, describe the text in the fewest bits per character wins.

Letters are lower-cased and everything else is one space.  Texts are parsed in
segments of ``SEGMENT`` characters, all of them, so that the segments of many texts
advance side by side; a segment border costs every language the same.

A null text or one without a letter is ``und`` with score 0.  Ties go to the first
language in order.  Without labelled text everything is ``und``.  Repeated rows and
other columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import pieces_of, share, shared_value

UNKNOWN = "und"
SEGMENT = 2048
#: Classes of characters: space, other letters, and the most frequent letters.
CLASSES = 64


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings of ``codes``."""
    steps: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and c not in steps[at]:
            steps[at][c] = new
            at = link[at]
        if at >= 0:
            to = steps[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(steps)
                steps.append(dict(steps[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and steps[at].get(c) == to:
                    steps[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return steps


class CrossParser:
    """Parses many texts at once against the samples of all languages."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.languages = sorted(samples)
        letters = Counter(c for text in samples.values() for c in text.lower() if c.isalpha())
        alphabet = sorted(letters, key=lambda c: (-letters[c], c))[: CLASSES - 2]
        self.class_of = np.array([1 if chr(i).isalpha() else 0 for i in range(65536)], np.uint8)
        for k, c in enumerate(alphabet):
            if ord(c) < 65536:
                self.class_of[ord(c)] = k + 2
        tables, starts, self.bits, base = [], [], [], 0
        for language in self.languages:
            codes = self.codes([samples[language]])[0]
            steps = suffix_automaton(codes.tolist())
            table = np.zeros((len(steps), CLASSES), np.int64)
            root = np.zeros(CLASSES, np.int64)
            for c, to in steps[0].items():
                root[c] = to
            # A match that cannot go on ends a phrase, and the character begins the next one.
            table[:] = root << 1 | 1
            for at, step in enumerate(steps):
                for c, to in step.items():
                    table[at, c] = to << 1
            tables.append((((table >> 1) + base) * CLASSES << 1 | table & 1).astype(np.int32).ravel())
            starts.append(base * CLASSES)
            base += len(steps)
            self.bits.append(math.log2(len(codes) + 2))
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        self.starts = np.array(starts, np.int32)

    def codes(self, texts: list[str]) -> list[np.ndarray]:
        """Character classes of every text, runs of non-letters as one space."""
        lowered = [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.class_of[np.minimum(points, 65535)]
        high = points > 65535
        if high.any():
            codes[high] = [1 if chr(p).isalpha() else 0 for p in points[high]]
        edges = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
        keep = codes > 0
        keep[1:] |= codes[:-1] > 0
        keep[edges[:-1][edges[:-1] < len(keep)]] = True
        edges = np.concatenate([[0], np.cumsum(keep)])[edges]
        codes = codes[keep]
        return [codes[a:b] for a, b in zip(edges[:-1], edges[1:])]

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Number of phrases, one row per text and one column per language."""
        out = np.zeros((len(coded), len(self.languages)), np.int64)
        flat = np.concatenate(coded) if coded else np.zeros(0, np.uint8)
        owner, begin, size, at = [], [], [], 0
        for i, codes in enumerate(coded):
            for a in range(0, len(codes), SEGMENT):
                owner.append(i)
                begin.append(at + a)
                size.append(min(SEGMENT, len(codes) - a))
            at += len(codes)
        if not owner:
            return out
        size = np.array(size)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = np.array(owner)[order], np.array(begin)[order], size[order]
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")
        state = np.repeat(self.starts[:, None], len(size), 1)
        # A phrase is open at the start of every segment.
        count = np.ones(state.shape, np.int32)
        for i, n in enumerate(active.tolist()):
            moved = self.table[state[:, :n] + flat[begin[:n] + i]]
            count[:, :n] += moved & 1
            state[:, :n] = moved >> 1
        np.add.at(out, owner, count.T)
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        coded = self.codes(texts)
        bits = self.phrases(coded) * np.array(self.bits)
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(np.minimum(bits.min(axis=1, keepdims=True) - bits, 0)).sum(axis=1)
        return [
            (self.languages[b], float(s)) if codes.any() else (UNKNOWN, 0.0)
            for codes, b, s in zip(coded, best, share)
        ]


def fit(docs: DataFrame, chars: int = 20_000, buckets: int = 48) -> dict[str, str]:
    """Sample text of each language: at most ``chars`` characters from at most ``buckets`` documents.

    Per language and hash bucket one document is chosen by its hash; what is collected is
    bounded by languages, buckets and characters.  Of the longest sample of a language,
    only as much is used as the others have, so that none is favoured by its size.
    """
    ids = (
        docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
        .select("lang", "doc_id", F.xxhash64("doc_id").alias("mark"))
        .groupBy("lang", F.pmod("mark", F.lit(buckets)).alias("bucket"))
        .agg(F.min(F.struct("mark", "doc_id")).alias("chosen"))
        .select("lang", "bucket", F.col("chosen.doc_id").alias("doc_id"))
    )
    rows = (
        docs.select("doc_id", "lang", "text")
        .join(F.broadcast(ids), ["doc_id", "lang"])
        .groupBy("lang", "bucket")
        .agg(F.min(F.substring("text", 1, chars)).alias("text"))
        .orderBy("lang", "bucket")
        .collect()
    )
    out: dict[str, str] = {}
    for row in rows:
        out[row["lang"]] = (out.get(row["lang"], "") + " " + row["text"])[:chars]
    return {k: v for k, v in out.items() if any(map(str.isalpha, v))}


PREDICTION_TYPE = "struct<lang_pred:string,score:double>"


def predict(docs: DataFrame, samples: dict[str, str], name: str = "language") -> DataFrame:
    """``docs`` with a column ``name``: lang_pred, and as score the share of that language in 2^-bits."""
    shared = share(docs.sparkSession, CrossParser, samples)

    @F.arrow_udf(PREDICTION_TYPE)
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = shared_value(shared)
        for batch in batches:
            rows = [row for part in pieces_of(batch) for row in parser.predict(part)]
            yield pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())],
                ["lang_pred", "score"],
            )

    return docs.withColumn(name, predicted("text"))
