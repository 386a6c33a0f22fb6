"""BPE encoding and decoding over a trie of the distinct words of a batch.

The words make up a trie of their symbols, held as their sorted list.  In a
depth-first walk every node gets the last token of the encoding of its prefix:
the longest vocabulary entry that ends there and may follow the last token of
what lies before it.  A prefix shared by many words is so encoded once, and a
word is read off by walking back from its end.  The last byte of a word is a
symbol of its own (byte + word end).  An automaton over the vocabulary names the
entries that end at a node.

Two tokens may stand side by side if no merge across their border would have
happened before the merges inside them; that is looked up once per pair.

Null and empty texts have no token.  Repeated rows, ties and other columns do not
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from ledgerloom.llm.shared import pieces_of, share, shared_value

#: Fixed values of the tokenizer file's kind: what parts a text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
#: Kinds of signs beside all others, which are 0.
LETTER, DIGIT = 1, 2
#: Words remembered by one task before it starts anew.
MEMORY = 400_000


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    spare = 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return out


class Encoder:
    """Encodes words, chunks between spaces, and whole texts."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        symbols = {c: b for b, c in letters.items()} | {c + END: 256 + b for b, c in letters.items()}
        self.id_of_symbol = {s: vocab[t] for t, s in symbols.items()}
        # Per token: the rank of the merge that makes it (single symbols: -1), its halves, its length.
        self.rank: dict[int, int] = {i: -1 for i in self.id_of_symbol.values()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        length = {i: 1 for i in self.rank}
        spelled = {i: (s,) for s, i in self.id_of_symbol.items()}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]):
            left, right, both = vocab[a], vocab[b], vocab[a + b]
            self.merged[left, right] = rank
            if both not in self.rank:
                self.rank[both], self.halves[both] = rank, (left, right)
                length[both] = length[left] + length[right]
                spelled[both] = spelled[left] + spelled[right]
        self.length = length
        self._build_automaton(spelled)
        self.special_pattern = None
        if self.special:
            self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words_of = word_splitter()
        self.may_follow: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}

    def _build_automaton(self, spelled: dict[int, tuple[int, ...]]) -> None:
        """States are beginnings of tokens; each knows the tokens that end there, longest first."""
        steps: list[dict[int, int]] = [{}]
        ending: list[list[tuple[int, int]]] = [[]]
        for token, symbols in spelled.items():
            at = 0
            for s in symbols:
                if s not in steps[at]:
                    steps[at][s] = len(steps)
                    steps.append({})
                    ending.append([])
                at = steps[at][s]
            ending[at].append((token, len(symbols)))
        shorter = [0] * len(steps)
        queue = list(steps[0].values())
        for at in queue:
            for s, to in steps[at].items():
                back = shorter[at]
                while back and s not in steps[back]:
                    back = shorter[back]
                shorter[to] = steps[back].get(s, 0)
                queue.append(to)
            ending[at] += ending[shorter[at]]
        self.steps, self.shorter, self.ending = steps, shorter, [tuple(e) for e in ending]
        self.moves: dict[int, int] = {}

    def move(self, state: int, symbol: int) -> int:
        at = state
        while at and symbol not in self.steps[at]:
            at = self.shorter[at]
        at = self.steps[at][symbol]
        self.moves[state << 9 | symbol] = at
        return at

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` apart when they meet.

        Looks back in time at the two tokens beside the border: they were there from the
        making of the younger one until one of them went into a larger token.
        """
        a, b, until, out = left, right, float("inf"), None
        while out is None:
            merge = self.merged.get((a, b))
            if merge is not None and merge < until:
                out = False
            elif self.rank[a] < 0 and self.rank[b] < 0:
                out = True
            elif self.rank[a] > self.rank[b]:
                until, a = self.rank[a], self.halves[a][1]
            else:
                # The same merge at the border comes first, being further left.
                until, b = self.rank[b] + 0.5, self.halves[b][0]
        self.may_follow[left << 20 | right] = out
        return out

    def encode_words(self, words: list[str]) -> None:
        """Puts the encodings of new words into ``self.words``.

        In sorted order the words are the depth-first walk of their trie: what a word
        shares with the one before it is the path already walked, whose states are kept.
        """
        raw_words = sorted([(w.encode("utf-8", "surrogatepass"), w) for w in words])
        depth = max([len(raw) for raw, _ in raw_words], default=0)
        token = [0] * (depth + 1)  # by depth: the last token of the prefix
        start = [0] * (depth + 1)  # by depth: the depth before that token
        state = [0] * (depth + 1)  # by depth: the automaton's state
        ending, moves, may_follow, follows = self.ending, self.moves, self.may_follow, self.follows
        earlier, walked = b"", 0
        for raw, word in raw_words:
            last = len(raw) - 1
            i, most = 0, min(walked, last)
            while i < most and earlier[i] == raw[i]:
                i += 1
            while i <= last:
                symbol = raw[i] + 256 if i == last else raw[i]
                at = moves.get(state[i] << 9 | symbol)
                if at is None:
                    at = self.move(state[i], symbol)
                i += 1
                state[i] = at
                for end, length in ending[at]:
                    before = i - length
                    if before:
                        fits = may_follow.get(token[before] << 20 | end)
                        if fits is None:
                            fits = follows(token[before], end)
                        if not fits:
                            continue
                    token[i], start[i] = end, before
                    break
            # The last node of a word is not on the path of longer words.
            earlier, walked = raw, last
            out = []
            while i:
                out.append(token[i])
                i = start[i]
            out.reverse()
            self.words[word] = tuple(out)

    def learn(self, chunks: set[str]) -> None:
        """Encodes chunks (what stands between spaces) not seen before."""
        new = chunks - self.chunks.keys()
        if len(self.chunks) + len(new) > MEMORY:
            self.chunks.clear()
            self.words.clear()
            new = chunks
        parts = {c: [c] if c.isalpha() else self.words_of(c) for c in new if c[0] != " "}
        self.encode_words(list({w for ws in parts.values() for w in ws} - self.words.keys()))
        words = self.words
        for chunk, ws in parts.items():
            self.chunks[chunk] = words[ws[0]] if len(ws) == 1 else tuple(i for w in ws for i in words[w])
        for chunk in new - parts.keys():
            self.chunks[chunk] = (self.special[chunk[1:]],)

    def split(self, text: str) -> list[str]:
        """The chunks of a text; a special token is a chunk of its own, marked by a space."""
        if self.special_pattern is not None and "<|" in text:
            out = []
            for i, part in enumerate(self.special_pattern.split(text)):
                out += [" " + part] if i % 2 else _chunks(part)
            return out
        return _chunks(text)

    def encode_batch(self, texts: list[str]) -> list[list[tuple[int, ...]]]:
        """For each text the ids of its chunks."""
        parted = [self.split(t) for t in texts]
        self.learn({c for p in parted for c in p})
        return [list(map(self.chunks.__getitem__, p)) for p in parted]

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_batch([text])[0] for i in ids]

    def decode(self, ids: list[int]) -> str:
        """Token names joined by a space, as the file names no decoder."""
        names = self.names
        return " ".join([names[i] for i in ids if i in names])


def young_signs() -> frozenset[str]:
    """Letters and digits of younger Unicode versions than the tokenizers library knows.

    They are other signs to it; which ones those are is asked of its own patterns.
    """
    every = "".join(map(chr, chain(range(128, 0xD800), range(0xE000, 0x110000))))
    new = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
    left = Split(Regex(r"[\p{L}\p{N}]"), "removed").pre_tokenize_str(new)
    return frozenset("".join([piece for piece, _ in left]))


def kinds_of_signs() -> np.ndarray:
    """LETTER, DIGIT or 0 of every code point, as the words' pattern and the tokenizers library have it."""
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}")):
        out[np.array(list(map(ord, regex.findall(pattern, every))))] = kind
    out[np.array(list(map(ord, young_signs())), int)] = 0
    return out


def word_splitter() -> Callable[[str], list[str]]:
    """Splits a chunk into words."""
    pattern = regex.compile(WORD)
    young = young_signs()

    def words_of(chunk: str) -> list[str]:
        if chunk.isascii() or young.isdisjoint(chunk):
            return pattern.findall(chunk)
        masked = "".join(["\ue000" if c in young else c for c in chunk])
        return [chunk[m.start() : m.end()] for m in pattern.finditer(masked)]

    return words_of


def _chunks(text: str) -> list[str]:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        # str.split() also parts at four control characters that are no space here.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in regex.split(r"\s+", text.lower()) if c]
        return text.lower().split()
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [c for c in regex.split(r"[ \t-\r]+", text.lower()) if c]
    return text.lower().split()


DIGEST_TYPE = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def digests(texts: DataFrame, file: str, name: str = "bpe", keep_ids: bool = False) -> DataFrame:
    """``texts`` with a column ``name``: n_tokens, ids_sha256, decoded_sha256 and, on request, the ids.

    ids_sha256 is over the decimal ids joined by a space, decoded_sha256 over the decoded text.
    """
    shared = share(texts.sparkSession, Encoder, file)
    kind = DIGEST_TYPE[:-1] + ",ids:array<int>>" if keep_ids else DIGEST_TYPE

    @F.arrow_udf(kind)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gc.disable()  # millions of live tuples and no cycle among them
        encoder = shared_value(shared)
        written: dict[tuple[int, ...], tuple[str, str]] = {}

        def forms(ids: tuple[int, ...]) -> tuple[str, str]:
            out = written.get(ids)
            if out is None:
                if len(written) > MEMORY:
                    written.clear()
                out = written[ids] = " ".join(map(str, ids)), encoder.decode(ids)
            return out

        sha = lambda text: hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            rows = []
            for part in pieces_of(batch):
                for chunks in encoder.encode_batch(part):
                    pairs = list(map(forms, chunks))
                    row = [
                        sum(map(len, chunks)),
                        sha(" ".join([a for a, _ in pairs])),
                        sha(" ".join([b for _, b in pairs])),
                    ]
                    rows.append(row + [[i for c in chunks for i in c]] if keep_ids else row)
            types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 if keep_ids else 3]
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], types[i]) for i in range(len(names))], names
            )

    return texts.withColumn(name, encoded("text"))


def decoded(rows: DataFrame, file: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """``rows`` with a column ``name``: the text of the array of ids; null decodes to an empty text."""

    shared = share(rows.sparkSession, Encoder, file)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = shared_value(shared)
        for batch in batches:
            yield pa.array([encoder.decode(i or []) for i in batch.to_pylist()], pa.string())

    return rows.withColumn(name, texts(ids))
