"""Packing by lexical retrieval.

Documents become token ids, ended by one id, and are dealt to shards by the smallest
hash among their tokens, so that texts that share words tend to meet; a shard is cut
by its number of tokens, never by key.  Over a shard stands an inverted index of BM25
weights, with document frequencies of the whole corpus.  A seed document asks the
index for unused neighbours, which fill the rest of its window in the order of their
score.  The one that does not fit is cut, and its rest seeds the next window.  What is
left at the end of a shard is cut into sequences whose lengths are powers of two, so
no sequence is padded.

Null and empty texts are the end id alone.  Repeated rows are packed one by one,
equal scores go to the earlier document in the shard's order (hash, id, ids), a null
id sorts first, other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import DIGIT, END, _chunks, byte_letters, kinds_of_signs
from ledgerloom.llm.shared import pieces_of, same, share, shared_value, stored

WINDOW, CLOSING_ID = 2048, 1
#: Chunks remembered by one worker: those met again, and young ones met once; characters encoded at a time.
MEMORY, YOUNG, AT_ONCE = 400_000, 200_000, 8_000_000
#: Chunks put into one Arrow array, words merged at a time, and the chunk that stands for the end of a text.
CHUNKS_AT_ONCE, WORDS_AT_ONCE, CLOSING = 200_000, 20_000, " "
#: English short forms after a quote: 's 't 'm 'd, 're 've 'll.
SHORT, LONG = list(b"stmd"), [a << 21 | b for a, b in (b"re", b"ve", b"ll")]
#: Tokens of a shard, and the terms of a seed that are asked for.
SHARD_TOKENS, ASKED = 3_000_000, 24
K1, B = 1.2, 0.75
NONE = 1 << 30


class BulkEncoder:
    """Encodes texts by their distinct chunks, and new chunks side by side, one merge a word and round."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.size = max(vocab.values()) + 1
        letters = byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + END] for b in range(256)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in merges], np.uint64)
        self.slots = np.full(1 << 18, NONE << 20, np.uint64)
        self.ranks = np.full(1 << 18, NONE, np.int64)
        for rank, (key, at) in enumerate(zip(keys, self._slot(keys).tolist())):
            while self.ranks[at] != NONE:
                at = (at + 1) & ((1 << 18) - 1)
            self.slots[at], self.ranks[at] = key, rank
        # Ranks of two bytes side by side; 256 is added to the last byte of a word.
        self.beside = self.rank(np.repeat(self.inner, 512), np.tile(np.concatenate([self.inner, self.last]), 256))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.kinds = kinds_of_signs()
        self.forget()

    def forget(self) -> None:
        marks = {" " + c: i for c, i in self.special.items()} | {CLOSING: CLOSING_ID}
        self.chunks = Chunks(marks)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 16 | right).astype(np.uint64)
        at = self._slot(keys)
        out = np.full(len(keys), NONE, np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            found, ranks = self.slots[at], self.ranks[at]
            hit = found == keys[open_]
            out[open_[hit]] = ranks[hit]
            go = ~hit & (ranks != NONE)
            open_, at = open_[go], (at[go] + 1) & ((1 << 18) - 1)
        return out

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that follow one another in ``data``, and how many ids each has."""
        ids = self.inner[data]
        ends = np.cumsum(sizes) - 1
        ids[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(sizes)), sizes)
        symbols = data.astype(np.int64)
        symbols[ends] += 256
        rank = np.full(len(ids), NONE, np.int64)
        rank[:-1] = self.beside[(data[:-1].astype(np.int64) << 9) + symbols[1:]]
        rank[ends] = NONE
        done_ids, done_words = [], []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank << 31 | np.arange(len(ids)), starts)
            lowest, at = best >> 31, best & ((1 << 31) - 1)
            over = lowest == NONE
            keep = np.repeat(~over, np.diff(np.append(starts, len(ids))))
            done_ids.append(ids[~keep])
            done_words.append(word[~keep])
            at = at[~over]
            ids[at] = self.made[lowest[~over]]
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            ids, word, rank = ids[keep], word[keep], rank[keep]
            # Only the pairs on both sides of a new symbol have changed.
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = NONE
            changed = changed[changed + 1 < len(ids)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed] = self.rank(ids[changed], ids[changed + 1])
        ids, word = np.concatenate(done_ids), np.concatenate(done_words)
        return ids[np.argsort(word, kind="stable")].astype("<u2"), np.bincount(word, minlength=len(sizes))

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, and where each word's begin and how many they are.

        Words of like length go together, so that few rounds are run for a few long ones.
        """
        sizes = np.diff(edges_of(words))
        order = np.argsort(sizes, kind="stable")
        words, sizes = words.take(pa.array(order)), sizes[order]
        data, edges = data_of(words), edges_of(words)
        ids, counts = [np.zeros(0, "<u2")], [np.zeros(0, np.int64)]
        for at in range(0, len(sizes), WORDS_AT_ONCE):
            some = sizes[at : at + WORDS_AT_ONCE]
            found, count = self.merge(data[edges[at] : edges[at + len(some)]], some)
            ids.append(found)
            counts.append(count)
        count = np.concatenate(counts)
        starts, lengths = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        starts[order], lengths[order] = np.cumsum(count) - count, count
        return np.concatenate(ids), starts, lengths

    def words_in(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all chunks one after another, and the number of each chunk's first."""
        data, edges = data_of(chunks), edges_of(chunks)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        begins = np.zeros(len(data) + 1, bool)
        begins[edges] = True
        first = np.append(begins[lead], [True] * 3)
        kind = self.kinds[points]
        cut = first | np.append(kind == DIGIT, [False] * 3)
        cut[1 : len(kind)] |= kind[1:] != kind[:-1]
        # A quote that begins a word takes one or two letters along, if they end an English short form.
        quote = np.flatnonzero((points == ord("'")) & cut[: len(points)])
        one = np.where(first[quote + 1], 0, np.append(points, [0] * 2)[quote + 1])
        two = np.where(first[quote + 1] | first[quote + 2], 0, np.append(points, [0] * 2)[quote + 2])
        short = np.isin(one, SHORT)
        long = np.isin(one << 21 | two, LONG)
        cut[quote[short | long] + 1] = False
        cut[quote[short] + 2] = True
        cut[quote[long] + 3] = True
        cut = cut[: len(points)]
        starts = lead[cut]
        offsets = np.append(starts, len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
        return words, np.flatnonzero(first[: len(points)][cut])

    def encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and how many each has."""
        if not len(chunks):
            return np.zeros(0, "<u2"), np.zeros(0, np.int64)
        words, first = self.words_in(chunks)
        coded = words.dictionary_encode()
        ids, sizes = gathered(*self.encode_words(coded.dictionary), coded.indices.to_numpy())
        return ids, np.add.reduceat(sizes, first)

    def split(self, text: str) -> list[str]:
        if self.specials is not None and "<|" in text:
            parts = self.specials.split(text)
            return [c for i, p in enumerate(parts) for c in ([" " + p] if i % 2 else _chunks(p))]
        return _chunks(text)

    def encode_closed(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with the closing id, and how many each text has.

        Texts become rows of a table of their distinct chunks, and only that table is looked up.
        """
        arrays, chunks, counts = [], [], []
        for text in texts:
            found = self.split(text)
            chunks += found
            chunks.append(CLOSING)
            counts.append(len(found) + 1)
            if len(chunks) > CHUNKS_AT_ONCE:
                arrays.append(pa.array(chunks, pa.string()))
                chunks = []
        arrays.append(pa.array(chunks, pa.string()))
        coded = pa.chunked_array(arrays).dictionary_encode()
        codes = [c.indices.to_numpy() for c in coded.chunks]
        names = coded.chunk(0).dictionary
        times = sum(np.bincount(c, minlength=len(names)) for c in codes)
        table = self.chunks.look_up(names, times, self.encode_chunks)
        parts = [gathered(*table, c) for c in codes]
        first = np.cumsum(counts) - counts
        return np.concatenate([ids for ids, _ in parts]), np.add.reduceat(np.concatenate([k for _, k in parts]), first)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, without the closing id."""
        ids, sizes = self.encode_closed(texts)
        ends = np.cumsum(sizes)
        return [ids[e - k : e - 1].tobytes() for e, k in zip(ends.tolist(), sizes.tolist())]


class Chunks:
    """Ids of chunks met more than once, and of some that always stay, as one table.

    Most distinct chunks of a corpus are met once.  They are kept as young for a while, and
    only those met again in that time are remembered longer, so the table stays small.
    """

    def __init__(self, fixed: dict[str, int]) -> None:
        self.fixed = len(fixed)
        self.names = pa.array(fixed, pa.string())
        self.ids, self.sizes = np.array(list(fixed.values()), "<u2"), np.ones(len(fixed), np.int64)
        self.often = np.ones(len(fixed), bool)

    def __len__(self) -> int:
        return int(self.often.sum())

    def keys(self) -> set[str]:
        return set(self.names.filter(pa.array(self.often)).to_pylist())

    @property
    def young(self) -> set[str]:
        return set(self.names.filter(pa.array(~self.often)).to_pylist())

    def look_up(
        self,
        names: pa.Array,
        times: np.ndarray,
        encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks, and where each chunk's begin and how many they are; new ones are learned."""
        rows = pc.fill_null(pc.index_in(names, self.names), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(rows < 0)
        known = len(self.names)
        self.often[rows[rows >= 0]] = True
        fresh = names.take(pa.array(new))
        ids, sizes = encode(fresh)
        rows[new] = known + np.arange(len(new))
        ids, sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        starts = np.cumsum(sizes) - sizes
        # A memory grown too large is given up for what is new.
        stay = np.where(self.often, len(self) <= MEMORY, np.sum(~self.often) <= YOUNG)
        stay[: self.fixed] = True
        stay = np.flatnonzero(np.append(stay, np.ones(len(new), bool)))
        self.often = np.append(self.often, times[new] > 1)[stay]
        self.names = pa.concat_arrays([self.names, fresh]).take(pa.array(stay))
        self.ids, self.sizes = gathered(ids, starts, sizes, stay)
        return ids, starts[rows], sizes[rows]


def edges_of(texts: pa.Array) -> np.ndarray:
    """Where the bytes of each text begin, and where the last one ends."""
    edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    return edges - edges[0]


def data_of(texts: pa.Array) -> np.ndarray:
    """The bytes of all texts, one after another."""
    edges = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    data = texts.buffers()[2]
    return np.frombuffer(data or b"", np.uint8)[edges[0] : edges[-1]]


def gathered(
    ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the rows one after another, and how many each row has."""
    size = sizes[rows]
    ends = np.cumsum(size)
    at = np.repeat(starts[rows] - ends + size, size)
    at += np.arange(len(at))
    return ids[at], size


def larger(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``least`` bytes or more, as far as they go."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(h.nbytes for h in held) >= least:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def tokenized(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, ids (16-bit, with the closing id), n and the smallest token hash of every row."""
    shared = share(docs.sparkSession, BulkEncoder, file)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # very many live strings and no cycle among them
        encoder = shared_value(shared)
        marks = np.random.default_rng(11).permutation(encoder.size).astype(np.uint16)
        try:
            for b in larger(batches, AT_ONCE):
                at = 0
                for part in pieces_of(b.column(1), AT_ONCE):
                    flat, sizes = encoder.encode_closed(part)
                    edges = np.append(0, np.cumsum(sizes))
                    smallest = np.minimum.reduceat(marks[flat], edges[:-1])
                    offsets = pa.py_buffer((edges * 2).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0).slice(at, len(part)),
                            pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, offsets, pa.py_buffer(flat)]),
                            pa.array(sizes, pa.int64()),
                            pa.array(smallest, pa.int64()),
                        ],
                        ["doc_id", "ids", "n", "mark"],
                    )
                    at += len(part)
        finally:
            # The worker lives on; what packs in it next needs the room.
            encoder.forget()
            gc.enable()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encoded, "doc_id long, ids binary, n long, mark long"
    )


def distinct_ids(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids of each document in rising order: id, how often, and the document's number.

    One sort of all of them, with the document above the id.
    """
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = np.uint32 if len(docs) <= 1 << 16 else np.uint64
    keys = np.repeat(np.arange(len(docs), dtype=kind), [len(d) for d in docs])
    keys = np.sort(keys << kind(16) | np.concatenate(docs).astype(kind))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    found = keys[first]
    times = np.diff(np.append(first, len(keys)))
    return (found & kind(0xFFFF)).astype(np.int64), times, (found >> kind(16)).astype(np.int64)


def document_frequencies(tokens: DataFrame) -> dict[int, int]:
    """In how many documents each id occurs; one number per entry of the vocabulary."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for b in batches:
            terms, _, _ = distinct_ids([np.frombuffer(ids, "<u2") for ids in b.column(0).to_pylist()])
            counts += np.bincount(terms, minlength=1 << 16)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in rows.collect()}


class Bm25Index:
    """Postings of a shard: per term the documents and their weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        terms, counts, owner = distinct_ids(docs)
        times = counts.astype(float)
        sizes = np.bincount(owner, minlength=len(docs))
        length = np.array([len(d) for d in docs])[owner]
        weight = idf[terms] * times * (K1 + 1) / (times + K1 * (1 - B + B * length / mean_length))
        self.edges = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.weight, self.n = terms, weight, len(docs)
        order = np.argsort(terms, kind="stable")
        self.docs, self.scores = owner[order], weight[order]
        self.first = np.searchsorted(terms[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int, unused: np.ndarray, most: int) -> np.ndarray:
        """Unused documents that share a term with the seed, best first."""
        a, b = self.edges[seed], self.edges[seed + 1]
        terms = self.terms[a:b]
        if len(terms) > ASKED:
            terms = terms[np.argpartition(-self.weight[a:b], ASKED)[:ASKED]]
        spans = [slice(self.first[t], self.first[t + 1]) for t in np.sort(terms)]
        score = np.bincount(
            np.concatenate([self.docs[s] for s in spans]),
            np.concatenate([self.scores[s] for s in spans]),
            self.n,
        )
        score[~unused] = 0
        hits = np.flatnonzero(score)
        if len(hits) > most:
            bar = np.partition(score[hits], -most)[-most]
            hits = hits[score[hits] >= bar]
        return hits[np.argsort(-score[hits], kind="stable")]


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean_length: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard."""
    index = Bm25Index(docs, idf, mean_length)
    unused = np.ones(len(docs), bool)
    out: list[tuple[int, int, int, int, int]] = []
    sequence, filled, order = 0, 0, 0

    def put(doc: int, start: int) -> int:
        """Fills the window with the document from ``start`` on; where its rest begins."""
        nonlocal sequence, filled
        take = min(WINDOW - filled, len(docs[doc]) - start)
        out.append((doc, start, take, sequence, filled))
        filled += take
        if filled == WINDOW:
            sequence, filled = sequence + 1, 0
        return start + take

    seed, start = None, 0
    while True:
        if seed is None:
            while order < len(docs) and not unused[order]:
                order += 1
            if order == len(docs):
                break
            seed, start = order, 0
            unused[seed] = False
        while start < len(docs[seed]):
            start = put(seed, start)
        if not filled:
            seed = None
            continue
        rest = None
        # Some neighbours at a time, until the window is full or none is left.
        while rest is None:
            near = index.neighbours(seed, unused, 32).tolist()
            if not near:
                break
            for doc in near:
                unused[doc] = False
                end = put(doc, 0)
                if not filled or end < len(docs[doc]):
                    rest = (doc, end)
                    break
        # A cut neighbour seeds the next window; without one the next document in order does.
        seed, start = rest if rest is not None and rest[1] < len(docs[rest[0]]) else (None, 0)
    return powers(out, sequence, filled)


def powers(pieces: list[tuple[int, int, int, int, int]], last: int, filled: int) -> list[tuple[int, int, int, int, int]]:
    """Cuts the last sequence, ``filled`` tokens long, into sequences of powers of two."""
    out = [p for p in pieces if p[3] < last]
    room = 0
    sequence, offset = last - 1, 0
    for doc, start, length, _, _ in (p for p in pieces if p[3] == last):
        while length:
            if not room:
                sequence, offset, room = sequence + 1, 0, 1 << filled.bit_length() - 1
                filled -= room
            take = min(room, length)
            out.append((doc, start, take, sequence, offset))
            start, length, room, offset = start + take, length - take, room - take, offset + take
    return out


def pack(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    tokens = stored(tokenized(docs, file))
    n, total = tokens.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = document_frequencies(tokens)
    idf = np.zeros(1 << 16)
    for term, count in frequency.items():
        idf[term] = np.log(1 + (n - count + 0.5) / (count + 0.5))
    shared = share(docs.sparkSession, same, (idf, max(total / max(n, 1), 1.0)))
    shards = max(1, -(-total // SHARD_TOKENS))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mean_length = shared_value(shared)
        base = TaskContext.get().partitionId() << 36
        held_ids: list = []
        held: list[np.ndarray] = []
        size = made = 0

        def flush() -> pa.RecordBatch:
            nonlocal made
            pieces = pack_shard(held, weights, mean_length)
            crc = [zlib.crc32(held[d][s : s + k].astype("<u4").tobytes()) for d, s, k, _, _ in pieces]
            columns = [
                pa.array([held_ids[p[0]] for p in pieces], pa.int64()),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([p[2] for p in pieces], pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array([len(held[p[0]]) for p in pieces], pa.int64()),
                pa.array([base + made + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
            ]
            made += 1 + max(p[3] for p in pieces)
            return pa.RecordBatch.from_arrays(columns, PIECE_COLUMNS)

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held_ids.append(doc_id)
                held.append(np.frombuffer(ids, "<u2"))
                size += len(ids) // 2
                if size >= SHARD_TOKENS:
                    yield flush()
                    held_ids, held, size = [], [], 0
        if held:
            yield flush()

    return (
        tokens.repartitionByRange(shards, "mark", "doc_id")
        .sortWithinPartitions("mark", "doc_id", "ids")
        .select("doc_id", "ids")
        .mapInArrow(packed, ", ".join(f"{c} long" for c in PIECE_COLUMNS))
    )


PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
