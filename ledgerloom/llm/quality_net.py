"""Quality classifier: random-indexing word vectors and a two-layer network.

Tokens are runs of letters and runs of other characters.  Every token has a fixed
sparse random index vector; the vector of a token is the sum of the index vectors of
its neighbours over all texts, centred and scaled, plus its own index vector.  Tokens
share ``BUCKETS`` vectors by hash, so the model is of one size for any corpus.  A
document is the mean and the spread of its token vectors and its length.

The network (one hidden layer) learns from a bounded sample of labelled documents;
a part of it is set aside to find the temperature that calibrates its probabilities.

Null and empty texts are the zero document and get its score.  Without labels every
score is 0.5.  Repeated rows and other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import pieces_of, same, share, shared_value

BUCKETS, DIMS, NONZERO = 4096, 32, 4
MEMORY = 400_000
#: Characters whose token vectors are in memory at once.
PART = 500_000


def index_vectors() -> np.ndarray:
    """One sparse vector of signs for each bucket."""
    rng = np.random.default_rng(5)
    out = np.zeros((BUCKETS, DIMS), np.float32)
    for row in out:
        row[rng.choice(DIMS, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out


class Tokens:
    """Buckets of the tokens of texts; words seen before are looked up."""

    def __init__(self) -> None:
        self.of_word: dict[str, tuple[int, ...]] = {}
        self.parts = regex.compile(r"\p{L}+|[^\p{L}]+").findall

    def buckets(self, word: str) -> tuple[int, ...]:
        out = []
        for part in self.parts(word):
            if len(part) > 1 and part.isupper():
                part = "<capitals>"
            elif part[0].isdigit():
                part = "<number>"
            out.append(zlib.crc32(part.lower().encode("utf-8", "surrogatepass")) % BUCKETS)
        return tuple(out)

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all texts one after another, tokens of each text, and distinct words of each text."""
        parted = [t.split() for t in texts]
        if len(self.of_word) > MEMORY:
            self.of_word.clear()
        look_up, sizes, distinct, flat = self.of_word, [], [], []
        for words in parted:
            own = set(words)
            distinct.append(len(own))
            for w in own:
                if w not in look_up:
                    look_up[w] = self.buckets(w)
            ids = list(chain.from_iterable(map(look_up.__getitem__, words)))
            sizes.append(len(ids))
            flat += ids
        return np.array(flat, np.int64), np.array(sizes, np.int64), np.array(distinct, np.int64)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket the sum of its neighbours' index vectors in this task's texts."""
    index = index_vectors()
    at = np.nonzero(index)[1].reshape(BUCKETS, NONZERO)
    sign = np.take_along_axis(index, at, axis=1)
    sums, tokens, any_text = np.zeros(BUCKETS * DIMS), Tokens(), False
    for b in batches:
        for part in pieces_of(b.column(0)):
            any_text = True
            ids, sizes, _ = tokens.batch(part)
            inside = np.ones(len(ids), bool)
            starts = np.cumsum(sizes)[:-1]
            inside[starts[starts < len(ids)]] = False
            here = np.flatnonzero(inside[1:]) + 1 if len(ids) else np.zeros(0, int)
            for a, c in ((ids[here - 1], ids[here]), (ids[here], ids[here - 1])):
                for k in range(NONZERO):
                    sums += np.bincount(a * DIMS + at[c, k], sign[c, k], BUCKETS * DIMS)
    if any_text:
        rows = sums.reshape(BUCKETS, DIMS)
        used = np.flatnonzero(np.abs(rows).sum(axis=1))
        columns = [pa.array(used, pa.int32()), *[pa.array(rows[used, d]) for d in range(DIMS)]]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *[f"v{d}" for d in range(DIMS)]])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The vectors of all buckets, learned from every text of ``docs``."""
    names = [f"v{d}" for d in range(DIMS)]
    rows = (
        docs.select("text")
        .mapInArrow(_context_sums, "bucket int, " + ", ".join(f"{n} double" for n in names))
        .groupBy("bucket")
        .agg(*[F.sum(n).alias(n) for n in names])
        .toPandas()
        .sort_values("bucket")
    )
    index = index_vectors()
    context = np.zeros((BUCKETS, DIMS))
    context[rows["bucket"].to_numpy(int)] = rows[names].to_numpy()
    # Counts of random signs are whole numbers, so the sums do not depend on their order.
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    unit = context / np.maximum(norm, 1e-9)
    used = norm[:, 0] > 0
    unit[used] -= unit[used].mean(axis=0) if used.any() else 0
    norm = np.linalg.norm(unit, axis=1, keepdims=True)
    return (unit / np.maximum(norm, 1e-9) + index / np.sqrt(NONZERO)).astype(np.float32)


def document_vectors(texts: list[str], tokens: Tokens, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the token vectors, log of the length, and the share of distinct words."""
    ids, sizes, distinct = tokens.batch(texts)
    out = np.zeros((len(texts), 2 * DIMS + 2))
    some = np.flatnonzero(sizes)
    if len(some):
        n = sizes[some]
        starts = np.cumsum(n) - n
        seen = vectors[ids]
        mean = np.add.reduceat(seen, starts, axis=0, dtype=float) / n[:, None]
        square = np.add.reduceat(seen * seen, starts, axis=0, dtype=float) / n[:, None]
        out[some, :DIMS] = mean
        out[some, DIMS : 2 * DIMS] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[some, 2 * DIMS] = np.log1p(n)
        out[some, 2 * DIMS + 1] = distinct[some] / n
    return out


@dataclass
class Network:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, hidden: int = 32, epochs: int = 40) -> Network:
    """Adam on the log loss over four fifths of the rows; the temperature is fitted on the rest."""
    rng = np.random.default_rng(3)
    width = x.shape[1]
    net = Network(
        vectors,
        x.mean(axis=0) if len(x) else np.zeros(width),
        x.std(axis=0) + 1e-6 if len(x) else np.ones(width),
        rng.normal(0, width**-0.5, (width, hidden)),
        np.zeros(hidden),
        np.zeros(hidden),
        0.0,
        1.0,
    )
    if not len(x):
        return net
    aside = np.arange(len(x)) % 5 == 0
    z, t = ((x - net.mean) / net.scale)[~aside], y[~aside]
    net.w2 = rng.normal(0, hidden**-0.5, hidden)
    p = [net.w1, net.b1, net.w2, np.array([0.0])]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for a in range(0, len(z), 256):
            rows = order[a : a + 256]
            h = np.tanh(z[rows] @ p[0] + p[1])
            out = h @ p[2] + p[3][0]
            error = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - t[rows]) / len(rows)
            back = np.outer(error, p[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ error + 1e-4 * p[2], np.array([error.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p[0], p[1], p[2], float(p[3][0])
    if aside.any():
        logits, t = net.logits(x[aside]), y[aside]
        losses = []
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        for temperature in grid:
            q = np.clip(1 / (1 + np.exp(-np.clip(logits / temperature, -30, 30))), 1e-9, 1 - 1e-9)
            losses.append(-(t * np.log(q) + (1 - t) * np.log(1 - q)).mean())
        net.temperature = float(grid[int(np.argmin(losses))])
    return net


def fit(docs: DataFrame, labelled: DataFrame, label: str = "quality", sample: int = 16_000) -> Network:
    """Word vectors from all of ``docs``; the network from at most ``sample`` ids of ``labelled``, by their hash."""
    vectors = word_vectors(docs)
    marked = (
        labelled.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .select("doc_id", F.col(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(sample)
    )
    shared = share(docs.sparkSession, same, vectors)

    @F.arrow_udf("array<double>")
    def pooled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, vectors_ = Tokens(), shared_value(shared)
        for batch in batches:
            rows = [r for part in pieces_of(batch, PART) for r in document_vectors(part, tokens, vectors_)]
            yield pa.array(rows, pa.list_(pa.float64()))

    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(marked), "doc_id")
        .select(F.xxhash64("doc_id").alias("mark"), "doc_id", "y", pooled("text").alias("x"))
        .toPandas()
    )
    rows["key"] = [tuple(x) for x in rows["x"]]
    rows = rows.sort_values(["mark", "doc_id", "y", "key"], ignore_index=True)
    x = np.array(rows["key"].tolist(), float).reshape(len(rows), 2 * DIMS + 2)
    return train(x, rows["y"].to_numpy(float), vectors)


def score(docs: DataFrame, net: Network, name: str = "quality") -> DataFrame:
    """``docs`` with a column ``name``: the probability of label 1."""
    shared = share(docs.sparkSession, same, net)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, model = Tokens(), shared_value(shared)
        for batch in batches:
            out = [model.probabilities(document_vectors(p, tokens, model.vectors)) for p in pieces_of(batch, PART)]
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    return docs.withColumn(name, scored("text"))
