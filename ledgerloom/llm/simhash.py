"""SimHash near-duplicates by multi-index hashing.

Fingerprints are taken apart into two halves of 32 bits.  Two fingerprints that
differ in at most two bits either have equal second halves, or first halves that
differ in at most one bit.  So every distinct fingerprint is entered into a table
by each half, and looks up the Hamming ball of radius one (33 values) around its
first half and its second half itself.  Candidates are verified on all 64 bits.

Only distinct fingerprints meet, each with the smallest id that has it; copies join
the component of their fingerprint at the end.  Components are found by shrinking
stars, each round a written table.

Null texts count as empty; a text without a word has fingerprint zero and is linked
like any other.  A null id takes part in nothing and is left out.  Repeated rows
repeat in the result, other columns are ignored, an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over the XXH64 of word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row with an id."""

    @F.arrow_udf("bigint")
    def taken(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = np.array([fingerprint(t or "", width) for t in texts.to_pylist()], np.uint64)
            yield pa.array(values.view(np.int64))

    return docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), taken("text").alias("fp")
    )


def links(distinct: DataFrame, most: int = 2) -> DataFrame:
    """Pairs a < b of the distinct ``fp`` that differ in 1 to ``most`` bits, each once; ``most`` is 1 or 2."""
    first = F.shiftrightunsigned("fp", 32)
    second = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    ball = F.array(F.lit(0).cast("long"), *[F.lit(1 << b) for b in range(32)])
    table = distinct.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("half"), first.alias("value")),
                F.struct(F.lit(1).alias("half"), second.alias("value")),
            )
        ),
        F.col("fp").alias("b"),
    )
    probes = distinct.select(
        F.inline(
            F.concat(
                F.transform(ball, lambda x: F.struct(F.lit(0).alias("half"), first.bitwiseXOR(x).alias("value"))),
                F.array(F.struct(F.lit(1).alias("half"), second.alias("value"))),
            )
        ),
        F.col("fp").alias("a"),
    )
    return (
        probes.join(table, ["half", "value"])
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most))
        .select("a", "b")
        .distinct()
    )


def components(pairs: DataFrame) -> DataFrame:
    """node and its root, the smallest node reachable, for every node in ``pairs`` (a, b).

    Alternates large and small stars: neighbours above a node go to the smallest
    neighbour, then those below it do.  Both are a minimum per node joined back, so no
    neighbourhood is gathered in one place.
    """
    edges = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small)
        # The figures of a set of edges; equal twice in a row only when nothing moves.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 3, most: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest id reachable) of every row."""
    taken = stored(fingerprints(docs, width))
    distinct = stored(taken.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, most))
    linked = stored(
        distinct.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "least")
    )
    lowest = linked.groupBy("root").agg(F.min("least").alias("linked_id"))
    of_linked = linked.join(lowest, "root").select("fp", "linked_id")
    named = distinct.join(of_linked, "fp", "left").select(
        "fp", F.coalesce("linked_id", "least").alias("component_id")
    )
    return taken.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
