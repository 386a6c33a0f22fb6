"""The weighted tree against a plain recursive one, and texts in parts against whole ones."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from ledgerloom.llm import ctw
from ledgerloom.llm.shared import same, shared_value


def kt(zeros, ones):
    """Natural log of the KT probability, bit by bit."""
    out, seen = 0.0, [0, 0]
    for bit in [0] * zeros + [1] * ones:
        out += math.log((seen[bit] + 0.5) / (sum(seen) + 1))
        seen[bit] += 1
    return out


def plain(texts, kept, context, byte):
    """log10 probability of ``byte`` after ``context`` (latest byte first), by recursion over the kept contexts."""
    grams = Counter()
    for t in texts:
        data = ctw.EDGE * ctw.DEPTH + t + ctw.EDGE
        for i in range(ctw.DEPTH, len(data)):
            grams[data[i - ctw.DEPTH : i][::-1], data[i]] += 1

    def decisions(path, bit, above, children):
        """Zeros and ones of a decision after a context, less those of its kept children."""
        zeros = ones = 0
        for (c, b), n in grams.items():
            if c.startswith(path) and b >> 8 - bit == above and not any(c.startswith(k) for k in children):
                if b >> 7 - bit & 1:
                    ones += n
                else:
                    zeros += n
        return zeros, ones

    def weighted(path, bit, above):
        """(log weighted probability, weight of the node's own estimate)."""
        alone = kt(*decisions(path, bit, above, ()))
        if len(path) == ctw.DEPTH:
            return alone, 1.0
        children = [k for k in kept if len(k) == len(path) + 1 and k.startswith(path)]
        split = sum(weighted(k, bit, above)[0] for k in children) + kt(*decisions(path, bit, above, children))
        both = np.logaddexp(alone, split) - math.log(2)
        return both, math.exp(alone - math.log(2) - both)

    total = 0.0
    for bit in range(8):
        above, p, left, path = byte >> 8 - bit, 0.0, 1.0, b""
        while True:
            own = weighted(path, bit, above)[1]
            zeros, ones = decisions(path, bit, above, ())
            p += left * own * (ones + 0.5) / (zeros + ones + 1)
            left *= 1 - own
            longer = context[: len(path) + 1]
            if len(path) == ctw.DEPTH:
                break
            children = [k for k in kept if len(k) == len(path) + 1 and k.startswith(path)]
            if longer not in children:
                zeros, ones = decisions(path, bit, above, children)
                p += left * (ones + 0.5) / (zeros + ones + 1)
                break
            path = longer
        total += math.log10(p if byte >> 7 - bit & 1 else 1 - p)
    return total


def number(path):
    return sum(b << 8 * i for i, b in enumerate(path))


@pytest.mark.parametrize("texts,depth", [([b"abab", b"abb"], 5), ([b"aaaa"], 2), ([b"", b"xyxyx", b"y"], 3)])
def test_weights_equal_a_plain_recursive_tree(texts, depth):
    seen = set()
    for t in texts:
        data = ctw.EDGE * ctw.DEPTH + t + ctw.EDGE
        for i in range(ctw.DEPTH, len(data)):
            seen |= {data[i - ctw.DEPTH : i][::-1][:d] for d in range(depth + 1)}
    kept = sorted(seen - {b"".join([b"b", b"a", b"b"])}, key=lambda p: (len(p), number(p)))
    kept = [p for p in kept if all(p[:d] in kept for d in range(len(p)))]
    nodes = [{} for _ in range(depth + 1)]
    for p in kept:
        nodes[len(p)][number(p)] = len(nodes[len(p)])
    counts = [np.zeros((len(n), 256), np.int64) for n in nodes]
    for g, n in Counter(ctw.grams(texts)[0].tolist()).items():
        for d, level in enumerate(nodes):
            at = level.get(g >> 8 & (1 << 8 * d) - 1)
            if at is not None:
                counts[d][at, g & 255] += n
    table = ctw.weigh(nodes, counts)
    scorer = ctw.Scorer(np.array([c | d << 56 for d in range(depth + 1) for c in nodes[d]], np.uint64), table, {}, depth)
    for text in (b"ab", b"xy", b"q"):
        data = ctw.EDGE * ctw.DEPTH + text + ctw.EDGE
        want = sum(plain(texts, kept, data[i - ctw.DEPTH : i][::-1], data[i]) for i in range(ctw.DEPTH, len(data)))
        assert scorer.logs([text])[0] == pytest.approx(want, rel=1e-4)


def test_long_texts_are_read_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 101, n).astype(np.uint8).tobytes() for n in (5, 0, 1000, 3, 64, 63, 200, 0)]
    whole, starts = ctw.grams(texts)
    scorer = ctw.Scorer(np.array([0], np.uint64), np.log10(np.full((1, 256), 1 / 300)) + np.arange(256) / 1e4, {}, 0)
    want = np.add.reduceat(scorer._of_bytes(whole), starts)
    monkeypatch.setattr(ctw, "AT_ONCE", 64)
    parts = list(ctw.parts_of(texts))
    assert max(len(p) for p, _, _ in parts) <= 2 * 64 + 8 and sum(e for _, e, _ in parts) == len(texts)
    assert sorted(np.concatenate([p for p, _, _ in parts]).tolist()) == sorted(whole.tolist())
    assert np.allclose(scorer.logs(texts), want)


def test_counts_do_not_depend_on_what_a_task_holds(monkeypatch):
    texts = pa.array(["abc abd " * 50, None, "", "the end", "xyz" * 400])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])

    def totals():
        out = Counter()
        for b in ctw.count_batches(iter([batch, batch])):
            for r in b.to_pylist():
                out[r["kind"], r["word"], r["gram"]] += r["n"]
        return out

    want = totals()
    monkeypatch.setattr(ctw, "AT_ONCE", 20)
    monkeypatch.setattr(ctw, "HELD", 9)
    assert totals() == want and want[0, ctw.END, 0] == 10


def all_nodes(texts):
    """The whole tree of the texts, as ``weigh`` takes it."""
    grams = Counter(ctw.grams(texts)[0].tolist())
    numbers = [sorted({g >> 8 & (1 << 8 * d) - 1 for g in grams}) for d in range(ctw.DEPTH + 1)]
    nodes = [{c: i for i, c in enumerate(level)} for level in numbers]
    counts = [np.zeros((len(n), 256), np.int64) for n in nodes]
    for g, n in grams.items():
        for d, level in enumerate(nodes):
            counts[d][level[g >> 8 & (1 << 8 * d) - 1], g & 255] += n
    keys = np.array([c | d << 56 for d, level in enumerate(nodes) for c in level], np.uint64)
    return ctw.Scorer(keys, ctw.weigh(nodes, counts), {}, ctw.DEPTH)


@pytest.mark.parametrize("carried", [0, 5, 10_000])
def test_no_context_is_left_out(spark, monkeypatch, carried):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcde \u00e9"), 9)) for _ in range(40)]
    learned = [" ".join(rng.choice(words, 12)) for _ in range(30)]
    others = [learned[3], None, "", "zebra abc", "\u00e9\u00e9 zz", words[0] + "q" + words[1]]
    monkeypatch.setattr(ctw, "WEIGHED", 300)
    docs = spark.createDataFrame(list(enumerate(learned)), "doc_id long, text string").coalesce(2)
    model = ctw.fit(docs, carried=carried)
    rows = ctw.score(spark.createDataFrame(list(enumerate(others)), "doc_id long, text string"), model).collect()
    want = all_nodes([ctw.lowered(t) for t in learned]).logs([ctw.lowered(t) for t in others])
    for r in rows:
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-4)
        size = len(ctw.lowered(others[r["doc_id"]])) + 1
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / size)
    assert len(rows) == len(others)


def test_what_a_worker_holds_for_scoring_is_small():
    rng = np.random.default_rng(5)
    grams = np.unique(rng.integers(0, 1 << 48, 300_000).astype(np.uint64))
    scorer = ctw.GramScorer(grams, np.arange(len(grams)) / 1e6, {})
    assert (scorer.slots.nbytes + scorer.rows.nbytes + scorer.table.nbytes) / len(grams) < 64
    assert (scorer.find(grams) == np.arange(len(grams))).all()
    assert (scorer.find(np.setdiff1d(grams + np.uint64(1), grams)) == -1).all()


def test_the_recipe_of_a_shared_value_goes_when_it_is_made():
    class Shared:
        value = [cloudpickle.dumps((same, ({"a": 1},)))]

    assert shared_value(Shared) == {"a": 1} and Shared.value[0] is None
    assert shared_value(Shared) is shared_value(Shared)
