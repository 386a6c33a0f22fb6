"""Exact top-k search by inner product over an impact-ordered index.

Every block of vectors has an index: per dimension its components in order, cut
into posting segments of equal length, each with the best component in it as its
quantised impact.  A query takes segments score-at-a-time, by descending impact
(query weight times the segment's best component, from the low end where the weight
is negative), into accumulators.  After each phase the sum still possible for a
vector is bounded by the impacts of the segments not taken; the k-th best exact score
known so far is the bar.  Once few vectors can still reach the bar, all that can are
scored exactly; after the last phase that is done for however many there are.  So no
vector that could be among the top k is missed, ties included.

Vectors that are null, or hold a null or a non-finite component, take no part; a
shorter vector counts as filled up with zeros.  A null id takes no part.  Equal
scores go to the smaller id; repeated rows of an id are rows of their own, but none
answers a query of its own id, and the smallest vector of an id is the query.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored

SEGMENT = 128
#: Shares of the posting segments after which the proof is tried.
PHASES = (0.5, 0.75)


class ImpactIndex:
    """Posting segments of one block of whole-number vectors."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        n = len(vectors)
        # By dimension the rows from the best component to the worst, and the other way round.
        down = np.argsort(-vectors, axis=0, kind="stable").T
        self.rows = (np.ascontiguousarray(down[:, ::-1]), np.ascontiguousarray(down))
        self.parts = tuple(np.take_along_axis(vectors.T, rows, axis=1) for rows in self.rows)
        self.cuts = np.append(np.arange(0, n, SEGMENT), n)

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Rows of all vectors that can be among the ``k`` best, and maybe more."""
        n, dims = self.vectors.shape
        way = (query >= 0).astype(int)
        best = np.stack([self.parts[w][d, self.cuts[:-1]] for d, w in enumerate(way)])
        impact = best * query[:, None]
        # Largest loss against the segments left behind comes first; in a dimension impacts fall.
        plan = np.argsort(-(impact - impact[:, -1:]), axis=None, kind="stable") // impact.shape[1]
        ahead = np.concatenate([impact, impact[:, -1:]], axis=1)
        taken = np.zeros(dims, np.int64)
        bound = ahead[:, 0]
        # Half the width where no sum can leave it.
        reach = np.abs(impact).max(initial=0) * 2 * dims
        kind = np.int32 if reach < 1 << 31 else np.int64
        over = np.zeros(n, kind)  # what a vector has over the bounds of the dimensions seen
        bar = None
        for share in PHASES:
            now = np.bincount(plan[: int(share * len(plan)) + 1], minlength=dims)
            tighter = ahead[np.arange(dims), now]
            for d, w in enumerate(way.tolist()):
                a, b = self.cuts[taken[d]], self.cuts[now[d]]
                rows = self.rows[w][d]
                if a and bound[d] != tighter[d]:
                    over[rows[:a]] += bound[d] - tighter[d]
                if b > a:
                    over[rows[a:b]] += (self.parts[w][d, a:b] * query[d] - tighter[d]).astype(kind)
            taken, bound = now, tighter
            most = over + bound.sum()
            tops = np.argpartition(-most, min(2 * k, n) - 1)[: 2 * k]
            exact = np.sort(self.vectors[tops] @ query)[::-1]
            if len(exact) < k:
                break
            bar = exact[k - 1] if bar is None else max(bar, exact[k - 1])
            left = np.flatnonzero(most >= bar)
            if len(left) <= max(8 * k, n // 3):
                return left
        return np.arange(n) if bar is None else np.flatnonzero(most >= bar)


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def search_block(block: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best of one block for each query, by (score, smaller id)."""
    columns = ["query_id", "vec_id", "score"]
    if block.empty or queries.empty:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
    dims = max(block["q"].map(len).max(), queries["q"].map(len).max(), 1)
    vectors, ids = _matrix(block["q"], dims), block["vec_id"].to_numpy()
    index = ImpactIndex(vectors)
    out = []
    # Rows of the query's own id are no candidates, so as many more are asked for.
    own = pd.Series(ids).value_counts()
    for query_id, q in zip(queries["query_id"], _matrix(queries["q"], dims)):
        rows = index.candidates(q, k + int(own.get(query_id, 0)))
        rows = rows[ids[rows] != query_id]
        scores = vectors[rows] @ q
        best = np.lexsort((ids[rows], -scores))[:k]
        out.append(np.stack([np.full(len(best), query_id), ids[rows[best]], scores[best]], axis=1))
    return pd.DataFrame(np.concatenate(out), columns=columns)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, rows_per_block: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``every`` the ``k`` best other rows."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    usable = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    points = stored(
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(usable)
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("q"))
    )
    n, n_queries = points.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    blocks = max(1, -(-n // rows_per_block))
    groups = max(1, -(-n_queries // rows_per_block))
    # Blocks are dealt by id, so many rows with one vector do not meet in one block.
    placed = points.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = (
        points.filter(F.col("vec_id") % every == 0)
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("q").alias("q"))
        .withColumn("ask", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
    )
    # Blocks meet blocks: each block of vectors goes to every block of queries and back.
    left = placed.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def searched(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return search_block(
            a.sort_values("vec_id", ignore_index=True), b.sort_values("query_id", ignore_index=True), k
        )

    found = (
        left.groupBy("block", "ask")
        .cogroup(right.groupBy("block", "ask"))
        .applyInPandas(searched, "query_id long, vec_id long, score long")
    )
    # A query has at most k rows from each block.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
