"""Differences of sources against a plain count."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from checks.compare import compare, connect
from ledgerloom.llm import divergence
from ledgerloom.llm.queries import QUERIES, SQL

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, top):
    """Rows of the result from (lang, source, text)."""
    counts, having, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        terms = TERM.findall(text.translate(CAPITALS))
        counts[lang, source].update(terms)
        having[lang].update(set(terms))
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in having[lang].items() if n >= least]
        whole = sum((counts[lang, s] for s in names), Counter())

        def share(c):
            size = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // size for t in kept}

        p, q = {s: share(counts[lang, s]) for s in names}, share(whole)
        for s in names:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in names if o != s]
            risen = [(q[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(risen)[:top])):
                out += [(lang, s, part, item, -value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def table(spark, rows):
    kinds = "lang string, source string, text string, n long, docs long, block int, place int, total int"
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], kinds).repartition(5)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def odd_rows():
    rnd = random.Random(9)
    words = ["aa", "B", "été", "日本", "Été", "cc", "D" * 50, "don't", "x1y", "🙂", "_", "tie", "tye"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for _ in range(300):
        lang = rnd.choice(["en", "en", "en", None, "", "ja"])
        rows.append((lang, rnd.choice(["s0"] * 6 + ["s1", "s2", None, ""]), " ".join(rnd.choices(words, k=rnd.randrange(9)))))
    return rows + [("en", "empty", None), ("en", "blank", " \n1 2"), ("xx", "a", "rare"), ("xx", "b", None), ("yy", "alone", "x")] + [
        ("en", "s0", "copy of one text")
    ] * 40


@pytest.mark.parametrize("least,top", [(1, 50), (5, 3), (1000, 50)])
def test_odd_rows(spark, least, top):
    assert rows_of(divergence.audit(table(spark, odd_rows()), least, top)) == plain(odd_rows(), least, top)


def test_small_blocks_parts_and_memory(spark, monkeypatch):
    """The same result from blocks of a few words, texts read in pieces and counts handed on early."""
    monkeypatch.setattr(divergence, "CELLS", 40)
    monkeypatch.setattr(divergence, "PART", 7)
    monkeypatch.setattr(divergence, "HELD", 5)
    assert rows_of(divergence.audit(table(spark, odd_rows()), 2, 4)) == plain(odd_rows(), 2, 4)


def test_given_documents_against_sql(spark, small):
    assert compare(QUERIES["op13_source_divergence"](spark, small), connect(small), SQL["op13_source_divergence"]) == []


def test_no_documents(spark):
    assert divergence.audit(table(spark, odd_rows()).limit(0)).count() == 0


def test_long_text(spark):
    rows = [("en", "a", "Word " * 700_000), ("en", "b", "word other")]
    assert rows_of(divergence.audit(table(spark, rows), 1, 50)) == plain(rows, 1, 50)


def test_shares_do_not_overflow():
    counts = np.array([0, 10**15, 9 * 10**18, 0], np.int64)
    n, v = 10**19, 4
    assert divergence.shares(counts, n, v).tolist() == [1 + 10**9 * (c + 5) // (n + 5 * v) for c in counts.tolist()]


def test_runs_and_their_intersection():
    rng = np.random.default_rng(1)
    for _ in range(50):
        size = int(rng.integers(1, 30))
        columns = [rng.integers(0, 3, size) for _ in range(2)]
        runs = [divergence.Runs(np.flatnonzero(c), c[c > 0], int(c.sum()), size) for c in columns]
        for c, r in zip(columns, runs):
            assert (r.counts[r.at(np.arange(size))] == c).all() and (np.diff(r.counts) != 0).all()
        starts, lengths, a, b = divergence.intersect(*runs, size)
        assert lengths.sum() == size and len(starts) <= len(runs[0].starts) + len(runs[1].starts)
        p = [divergence.shares(c, int(c.sum()), size) for c in columns]
        assert divergence.difference(*runs, size) == np.abs(p[0] - p[1]).sum()
