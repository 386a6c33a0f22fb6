"""The label model against a plain version, and where it must not drift."""

import math

import numpy as np
import pytest

from ledgerloom.llm.toxicity import label_model, likelihood


def plain_odds(votes, q, smooth, parent):
    """Log odds of each row by loops over rows and voters, for a given tree."""
    n, k = votes.shape
    out = []
    for row in votes:
        odds = 0.0
        for sign, w in ((1, q), (-1, 1 - q)):
            size = sum(w) + smooth
            for j in range(k):
                def share(**said):
                    hit = sum(w[r] for r in range(n) if all(votes[r][int(i[1:])] == v for i, v in said.items()))
                    return (hit + smooth / 3 ** len(said)) / size

                if parent[j] < 0:
                    odds += sign * math.log(share(**{f"v{j}": row[j]}))
                else:
                    p = parent[j]
                    odds += sign * math.log(share(**{f"v{j}": row[j], f"v{p}": row[p]}) / share(**{f"v{p}": row[p]}))
        out.append(odds)
    return np.array(out)


def votes_of(rng, n=60):
    truth = rng.random(n) < 0.3
    right = [np.where(rng.random(n) < 0.9, np.where(truth, 1, -1), 0) for _ in range(3)]
    return truth.astype(float), np.stack([*right, right[0], rng.integers(-1, 2, n)], axis=1)


@pytest.mark.parametrize("seed", range(4))
def test_odds_equal_plain_loops(seed):
    rng = np.random.default_rng(seed)
    truth, votes = votes_of(rng)
    q = np.clip(truth * 0.8 + rng.random(len(truth)) * 0.2, 0.01, 0.99)
    got, parent = likelihood(votes, q, 0.3, 1.0)
    assert parent.count(-1) == 1 and (parent[3] == 0 or parent[0] == 3)
    assert np.allclose(got, plain_odds(votes, q, 1.0, parent), atol=1e-9)


def test_a_repeated_voter_counts_once():
    truth, votes = votes_of(np.random.default_rng(9), 400)
    once = label_model(votes[:, [0, 1, 2]], truth)
    often = label_model(votes[:, [0, 1, 2, 0, 0, 0, 0]], truth)
    assert np.abs(once - often).max() < 0.05


@pytest.mark.parametrize("n, positive", [(40, 3), (300, 45), (3000, 30)])
def test_few_positives_do_not_vanish(n, positive):
    """Many correlated voters and a rare label: rows with hits keep a high posterior, others a low one."""
    y = np.zeros(n)
    y[:positive] = 1
    hit = y.copy()
    hit[: positive // 3] = 0  # labelled rows that no voter sees
    votes = np.stack([*[hit] * 6, *[hit - 1] * 3], axis=1).astype(int)
    q = label_model(votes, y)
    assert (q[positive // 3 : positive] > 0.95).all() and (q[positive:] < 0.1).all()


def test_labels_of_one_kind_and_no_rows():
    votes = np.array([[1, -1], [0, 0], [1, 1]])
    assert np.isfinite(label_model(votes, np.ones(3))).all() and np.isfinite(label_model(votes, np.zeros(3))).all()
