"""The parts of the operators against plain versions, and the fixed rules they keep."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, packing, simhash, topk
from ledgerloom.llm.language import CrossParser
from ledgerloom.llm.queries import VOCABULARY
from ledgerloom.llm.quality_rules import learn_list

FILE = public_tokenizers.path(VOCABULARY)
ENCODER, BULK, PLAIN = bpe.Encoder(FILE), packing.BulkEncoder(FILE), Tokenizer.from_file(FILE)
PLAIN.no_truncation()
PLAIN.no_padding()


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_both_encoders_equal_the_library(text):
    want = PLAIN.encode(text, add_special_tokens=False).ids
    assert ENCODER.encode(text) == want
    assert ENCODER.decode(want) == PLAIN.decode(want, skip_special_tokens=False)
    assert np.frombuffer(BULK.encode([text])[0], "<u2").tolist() in (want, want + [packing.CLOSING_ID])


def test_impact_index_keeps_every_member_of_the_top():
    rnd = np.random.default_rng(5)
    vectors = rnd.integers(-300, 300, (900, 12))
    vectors[100:400] = vectors[0]
    index = topk.ImpactIndex(vectors)
    for query in rnd.integers(-300, 300, (20, 12)):
        scores = vectors @ query
        least = np.sort(scores)[-5]
        assert set(np.flatnonzero(scores >= least)) <= set(index.candidates(query, 5))


def test_links_are_all_pairs_within_two_bits(spark):
    rnd = random.Random(9)
    values = set()
    for _ in range(40):
        base = rnd.getrandbits(64)
        values |= {base} | {base ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (rnd.random() < 0.3) for _ in range(6)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2}


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(10, 60)] + [(200, i) for i in range(201, 300)] + [(5, 5)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 10 for i in range(10, 61)) and all(got[i] == 200 for i in range(200, 300))


def test_cross_parser_prefers_the_language_it_has_seen():
    parser = CrossParser({"a": "the rain falls on the town " * 20, "b": "der regen faellt auf die stadt " * 20})
    told = parser.predict(["the town and the rain", "auf die stadt", "", "12 34"])
    assert [t for t, _ in told] == ["a", "b", "und", "und"] and told[2][1] == 0


def test_learned_rules_find_a_planted_threshold(spark):
    rnd = np.random.default_rng(1)
    x = rnd.random((2000, 2))
    rules = learn_list(x, x[:, 0] > 0.8, ["symbols_per_char", "n_words"])
    assert rules.rules
    hit = np.zeros(len(x), bool)
    for rule in rules.rules:
        inside = np.ones(len(x), bool)
        for c in rule:
            inside &= c.holds(x[:, ["symbols_per_char", "n_words"].index(c.figure)])
        hit |= inside
    assert np.mean(hit == (x[:, 0] > 0.8)) > 0.97


def test_decode_of_kept_ids_is_the_text(spark):
    texts = ["the old boat", "", None, "x" * 3000]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, ids int").drop("ids")
    rows = bpe.decoded(bpe.digests(df, FILE, "b", keep_ids=True).select("text", F.col("b.ids").alias("ids")), FILE, name="back")
    for r in rows.collect():
        ids = PLAIN.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.back == PLAIN.decode(ids, skip_special_tokens=False)


def test_distinct_ids_equal_one_unique_per_document():
    rng = np.random.default_rng(5)
    for n in (0, 1, 40, 70_000):
        docs = [rng.integers(0, 50_000, rng.integers(0 if n == 40 else 1, 4 if n > 100 else 30)).astype("<u2") for _ in range(n)]
        terms, times, owner = packing.distinct_ids(docs)
        want = [(t, c, i) for i, d in enumerate(docs) for t, c in zip(*np.unique(d, return_counts=True))]
        assert list(zip(terms.tolist(), times.tolist(), owner.tolist())) == want


def test_neighbours_equal_a_plain_bm25():
    """Scores and order of unused documents for seeds of few terms, against sums over all documents."""
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 60, rng.integers(1, 25)).astype("<u2") for _ in range(80)]
    idf, mean = rng.random(1 << 16), sum(map(len, docs)) / len(docs)
    index = packing.Bm25Index(docs, idf, mean)

    def weight(doc, term):
        times = int((doc == term).sum())
        return idf[term] * times * (packing.K1 + 1) / (times + packing.K1 * (1 - packing.B + packing.B * len(doc) / mean))

    for seed in range(20):
        unused = rng.random(len(docs)) < 0.7
        unused[seed] = False
        # Up to ASKED terms all count, as here.
        score = {i: sum(weight(d, t) for t in set(docs[seed].tolist())) for i, d in enumerate(docs) if unused[i]}
        got = index.neighbours(seed, unused, 1000).tolist()
        assert set(got) == {i for i, s in score.items() if s > 0}
        assert np.allclose([score[i] for i in got], sorted((s for s in score.values() if s > 0), reverse=True))


def test_encoder_remembers_only_chunks_met_again(monkeypatch):
    monkeypatch.setattr(packing, "YOUNG", 300)
    monkeypatch.setattr(packing, "MEMORY", 100)
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choices("abcdefgh-.7", k=9))
    often = [word() for _ in range(20)]
    encoder = packing.BulkEncoder(FILE)
    for _ in range(12):
        texts = [" ".join([word(), rnd.choice(often), word(), rnd.choice(often)]) for _ in range(80)]
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == PLAIN.encode(text, add_special_tokens=False).ids
        assert set(often) <= encoder.chunks.keys() and len(encoder.chunks) < 300
        assert len(encoder.chunks.young) < 1500


def test_encoder_looks_up_distinct_chunks_only(monkeypatch):
    """Chunks met again in the texts cost no look-up of their own; texts are put together from a table."""
    asked = []
    look_up = packing.Chunks.look_up
    monkeypatch.setattr(packing.Chunks, "look_up", lambda self, names, *rest: asked.append(len(names)) or look_up(self, names, *rest))
    monkeypatch.setattr(packing, "CHUNKS_AT_ONCE", 1000)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rnd.choices(words, k=200)) for _ in range(100)] + [""]
    got = packing.BulkEncoder(FILE).encode(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    assert asked == [51]


def test_bulk_encoder_parts_odd_chunks_as_the_library():
    """Quotes and short forms, digits, marks, letters of young Unicode versions, special tokens, long words."""
    rnd = random.Random(6)
    signs = ["'", "'s", "'re", "'ll", "'r", "'v", "'l", "r\u7265", "'r\u7265", "e", "s", "tm", "7", "\u00b2", "\u0664", "-", "...",
             "\u00e9", "e\u0301", "\u0130", "\u03a3", "\u5b57", "\U0001f600", *sorted(bpe.young_signs())[-2:], "\ue000", "\x00", "\x1c", "\x85",
             " ", "\u00a0", "\n", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "the", "DON'T", "x" * 300]
    texts = ["".join(rnd.choices(signs, k=rnd.randrange(12))) for _ in range(4000)] + signs
    encoder = packing.BulkEncoder(FILE)
    want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
    for step in (1, -1):
        got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts[::step])]
        assert got == want[::step]


def test_small_batches_are_encoded_together():
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    batches = [pa.record_batch([[i], ["a" * 40 if i % 3 else None]], schema) for i in range(50)]
    got = list(packing.larger(iter(batches), 500))
    assert [r for b in got for r in b.to_pylist()] == [r for b in batches for r in b.to_pylist()]
    assert 2 < len(got) < 10 and list(packing.larger(iter([]), 500)) == []
