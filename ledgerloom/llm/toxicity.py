"""Toxicity by weak supervision.

Voters look at a document: lexicons by theme, terms mined from labelled text (words and
beginnings of words that occur in toxic documents far more often than in others),
patterns of phrases, how many hits there are, and the absence of any.  A generative
label model estimates how often each voter is right and how much voters repeat each
other, and gives every document of a bounded labelled sample a posterior.  A linear
classifier is trained on those posteriors and scores all documents.

Null and empty texts have no hit and get the score of that.  Without labels only the
lexicons and patterns vote.  Repeated rows and other columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import pieces_of, same, share, shared_value, stored

#: Words of abuse by theme.
LEXICONS = {
    "insult": "idiot idiots moron morons stupid imbecile fool dumb dunce halfwit dimwit clown jerk loser losers",
    "contempt": "worthless pathetic disgusting trash scum garbage filth vermin parasite subhuman repulsive despicable",
    "profane": "damn crap bastard bitch shit fuck fucking asshole bullshit whore slut",
    "german": "idioten dummkopf abschaum trottel arschloch schwachkopf missgeburt",
    "romance": "idiota imbécil estúpido basura escoria mierda imbécile crétin débile ordure connard salaud",
}
#: Phrases of abuse.
PHRASES = ("shut up", "drop dead", "go to hell", "kill yourself", "hate you", "nobody likes you")
#: Lengths of the beginnings of words that are mined, in characters.
PREFIXES = (3, 4, 5, 6, 7, 8)
LONG_TEXT = 60
MEMORY = 400_000

# Letters in lower case; other ASCII characters part words.
_PLAIN = {i: " " for i in range(128) if not chr(i).isalpha()}


def words_of(text: str) -> list[str]:
    return text.lower().translate(_PLAIN).split()


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    if len(word) < 3:
        return []
    return [word, *[word[:n] + "*" for n in PREFIXES if n < len(word)]]


@dataclass
class Voters:
    """Turns a text into hits, votes and features."""

    mined: dict[str, int]  # term -> tier, 0 the surest
    tiers: int = 3
    seen: set[str] = field(default_factory=set)
    hits: dict[str, int] = field(default_factory=dict)  # word -> source

    def __post_init__(self) -> None:
        self.fixed = {w: i for i, words in enumerate(LEXICONS.values()) for w in words.split()}
        self.phrases = re.compile(r"\b(?:" + "|".join(PHRASES) + r")\b")
        self.sources = len(LEXICONS) + self.tiers

    def source(self, word: str) -> int | None:
        if word in self.fixed:
            return self.fixed[word]
        tiers = [self.mined[t] for t in terms_of(word) if t in self.mined]
        return len(LEXICONS) + min(tiers) if tiers else None

    def figures(self, text: str) -> list[float]:
        """Words, phrases, and distinct words hit by source."""
        words = words_of(text)
        distinct = set(words)
        if len(self.seen) > MEMORY:
            self.seen.clear()
            self.hits.clear()
        new = distinct - self.seen
        for w in new:
            source = self.source(w)
            if source is not None:
                self.hits[w] = source
        self.seen |= new
        out = [0.0] * (2 + self.sources)
        out[0], out[1] = len(words), len(self.phrases.findall(text.lower()))
        for w in self.hits.keys() & distinct:
            out[2 + self.hits[w]] += 1
        return out

    @staticmethod
    def votes(x: np.ndarray) -> np.ndarray:
        """One column per voter: 1 toxic, -1 clean, 0 no vote."""
        n, sources = x[:, 0], x[:, 2:]
        hits = sources.sum(axis=1) + x[:, 1]
        yes = [x[:, 1] > 0, *(sources > 0).T, hits >= 2, hits >= 3, hits >= 5, (hits > 0) & (hits * 150 >= n)]
        no = [hits == 0, (hits == 0) & (n >= LONG_TEXT), (hits == 1) & (n >= 1000)]
        return np.stack([*[v.astype(int) for v in yes], *[-v.astype(int) for v in no]], axis=1)

    @classmethod
    def features(cls, x: np.ndarray) -> np.ndarray:
        votes = cls.votes(x)
        hits = x[:, 2:].sum(axis=1) + x[:, 1]
        more = [np.log1p(x[:, 1:]), np.log1p(hits)[:, None], np.log1p(1000 * hits / np.maximum(x[:, 0], 50))[:, None]]
        return np.concatenate([votes, *more], axis=1)


def _tree(pairs: np.ndarray, prior: float) -> list[int]:
    """The parent of every voter (-1: none) in the tree of the most shared information given the label.

    ``pairs[y, i, a, j, b]`` is the share of rows of label y in which voter i says a and voter j says b.
    """
    k = pairs.shape[1]
    own = np.einsum("yiaia->yia", pairs)
    apart = own[:, :, :, None, None] * own[:, None, None, :, :]
    shared = (pairs * (np.log(pairs) - np.log(apart))).sum(axis=(2, 4))
    gain = (1 - prior) * shared[0] + prior * shared[1]
    parent, best, nearest = [-1] * k, np.full(k, -np.inf), np.zeros(k, int)
    left = set(range(1, k))
    last = 0
    while left:
        for j in left:
            if gain[last, j] > best[j]:
                best[j], nearest[j] = gain[last, j], last
        last = max(sorted(left), key=lambda j: best[j])
        left.remove(last)
        parent[last] = int(nearest[last])
    return parent


def likelihood(votes: np.ndarray, q: np.ndarray, prior: float, smooth: float) -> tuple[np.ndarray, list[int]]:
    """Log odds of the votes of every row under the labels' models fitted to ``q``, and the tree used.

    A label's model says each vote given the vote of its parent in the tree, so what
    voters repeat of each other counts once.
    """
    n, k = votes.shape
    said = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float).reshape(n, k * 3)
    pairs = np.empty((2, k, 3, k, 3))
    for y, w in ((0, 1 - q), (1, q)):
        joint = (said.T @ (said * w[:, None])).reshape(k, 3, k, 3) + smooth / 9
        own = said.T @ w
        for i in range(k):
            # A voter agrees with itself.
            joint[i, :, i, :] = np.diag(own[3 * i : 3 * i + 3] + smooth / 3)
        pairs[y] = joint / (w.sum() + smooth)
    with np.errstate(divide="ignore", invalid="ignore"):
        safe = np.where(pairs > 0, pairs, 1e-300)
    parent = _tree(safe, prior)
    own = np.einsum("yiaia->yia", safe)
    at = votes + 1
    odds = np.zeros(n)
    for i, p in enumerate(parent):
        table = np.log(own[:, i]) if p < 0 else np.log(safe[:, p, :, i, :]) - np.log(own[:, p])[:, :, None]
        odds += (table[1] - table[0])[at[:, i]] if p < 0 else (table[1] - table[0])[at[:, p], at[:, i]]
    return odds, parent


def label_model(
    votes: np.ndarray, labels: np.ndarray, trust: float = 0.95, rounds: int = 500, smooth: float = 1.0
) -> np.ndarray:
    """Posterior of label 1 for every row, by expectation maximisation to convergence.

    The share of the label stays that of ``labels``, and a label is evidence of its own,
    right in ``trust`` of cases; so votes explain the labels instead of drifting from them.
    The models of the votes are those of ``likelihood``.
    """
    prior = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    evidence = np.where(labels == 1, 1.0, -1.0) * np.log(trust / (1 - trust)) + np.log(prior / (1 - prior))
    q = np.where(labels == 1, trust, 1 - trust)
    for _ in range(rounds):
        odds, _ = likelihood(votes, q, prior, smooth)
        now = 1 / (1 + np.exp(-np.clip(evidence + odds, -30, 30)))
        change = np.abs(now - q).max(initial=0)
        q = now
        if change < 1e-7:
            break
    return q


def train_linear(x: np.ndarray, posterior: np.ndarray, rounds: int = 400, rate: float = 0.3) -> tuple[np.ndarray, ...]:
    """Logistic regression on soft labels: mean, scale, weights and bias."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - mean) / scale
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30))) - posterior
        w -= rate * (z.T @ error / len(z) + 1e-4 * w)
        b -= rate * error.mean()
    return mean, scale, w, np.array(b)


@dataclass
class Model:
    mined: dict[str, int]
    linear: tuple[np.ndarray, ...]

    def scores(self, figures: np.ndarray) -> np.ndarray:
        mean, scale, w, b = self.linear
        return 1 / (1 + np.exp(-np.clip((Voters.features(figures) - mean) / scale @ w + b, -30, 30)))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, and in how many toxic and other texts of this task it occurs."""
    toxic: Counter = Counter()
    other: Counter = Counter()
    for b in batches:
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            (toxic if y else other).update({t for w in set(words_of(text or "")) for t in terms_of(w)})
    terms = [*toxic, *(other.keys() - toxic.keys())]
    for a in range(0, len(terms), 50_000):
        part = terms[a : a + 50_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.string()),
                pa.array([toxic[t] for t in part], pa.int64()),
                pa.array([other[t] for t in part], pa.int64()),
            ],
            ["term", "toxic", "other"],
        )


def mine(sample: DataFrame, most: int = 600, tiers: int = 3, least: int = 8, ratio: float = 40.0) -> dict[str, int]:
    """The ``most`` best terms of texts labelled ``y``, with their tier; equal texts count once."""
    texts = sample.dropDuplicates(["text", "y"]).select("text", "y")
    n1, n0 = texts.agg(F.count(F.when(F.col("y") == 1, 1)), F.count(F.when(F.col("y") == 0, 1))).first()
    if not n1 or not n0:
        return {}
    odds = ((F.col("toxic") + 0.5) / (n1 + 1)) / ((F.col("other") + 0.5) / (n0 + 1))
    rows = (
        texts.mapInArrow(_term_counts, "term string, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .withColumn("odds", odds)
        .filter((F.col("toxic") >= max(min(least, 4 + n1 // 60), n1 // 100)) & (F.col("odds") >= ratio))
        .orderBy(F.desc(F.col("toxic") * F.log(F.col("odds"))), "term")
        .limit(most)
        .collect()
    )
    rows = sorted(rows, key=lambda r: (-r["odds"], r["term"]))
    return {r["term"]: i * tiers // len(rows) for i, r in enumerate(rows)}


def fit(docs: DataFrame, labelled: DataFrame, label: str = "toxic", sample: int = 16_000) -> Model:
    """Learns from at most ``sample`` ids of ``labelled``, in the order of their hash."""
    marked = (
        labelled.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .select("doc_id", F.col(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(sample)
    )
    rows = stored(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marked), "doc_id"))
    mined = mine(rows)
    shared = share(docs.sparkSession, Voters, mined)

    @F.arrow_udf("array<double>")
    def figures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        voters = shared_value(shared)
        for batch in batches:
            yield pa.array([voters.figures(t) for t in batch.to_pylist()], pa.list_(pa.float64()))

    got = rows.select("doc_id", "y", figures("text").alias("x")).toPandas()
    got["x"] = [tuple(v) for v in got["x"]]
    got = got.sort_values(["doc_id", "y", "x"], ignore_index=True)
    width = 2 + Voters(mined).sources
    x = np.array(got["x"].tolist(), float).reshape(len(got), width)
    y = got["y"].to_numpy(float)
    if not len(x):
        # The lexicons alone: any hit against none.
        x = np.zeros((4, width))
        x[:, 0], x[2:, 2], x[3, 3] = 100, 2, 1
        y = np.array([0, 0, 1, 1.0])
    posterior = label_model(Voters.votes(x), y)
    return Model(mined, train_linear(Voters.features(x), posterior))


def score(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``name``: the probability that it is toxic."""
    voters_ = share(docs.sparkSession, Voters, model.mined)
    model_ = share(docs.sparkSession, same, model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        voters, linear = shared_value(voters_), shared_value(model_)
        for batch in batches:
            out = [linear.scores(np.array([voters.figures(t) for t in p])) for p in pieces_of(batch)]
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    return docs.withColumn(name, scored("text"))
