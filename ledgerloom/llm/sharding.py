"""Shards of near-equal bytes by sampled splitters, in DataFrame operations only.

Records are ordered by a hash of their text and then their id, so equal texts lie
side by side.  A sample of keys, drawn with a chance in proportion to the size of
the record, gives quantile boundaries; records are dealt to the ranges between
them, overfull ranges (a hot text) are subdivided by id, and running sums of bytes
through the ranges cut the order into shards.  A shard so differs from the mean by
less than one record at either end.

Null texts count as empty.  Repeated rows are dealt like others, a null id sorts
first, an empty table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below ``key``, by a search in two steps."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) or 1
    heads = bounds[::step]
    array = lambda values: F.expr("array(" + ",".join(f"{v}L" if v > -(1 << 63) else "-9223372036854775807L" for v in values) + ")")
    block = F.size(F.filter(array(heads), lambda b: b <= key))
    first = F.greatest(block - 1, F.lit(0)) * step
    inside = F.size(F.filter(F.slice(array(bounds), first + 1, F.lit(step)), lambda b: b <= key))
    return F.when(block == 0, 0).otherwise(first + inside)


def shard_by_bytes(
    docs: DataFrame,
    n_shards: int = 24,
    rows_per_range: int = 20_000,
    draws_per_range: int = 16,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null) of every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        )
    )
    rows, total = base.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n_ranges = max(8 * n_shards, math.ceil(rows / rows_per_range))
    draws = n_ranges * draws_per_range

    # A row is drawn with chance size * draws / total, so the sample's quantiles are quantiles of bytes.
    coin = F.pmod(F.xxhash64(F.lit(17), "doc_id", "key"), F.lit(1 << 40)) / float(1 << 40)
    drawn = sorted(
        row[0] for row in base.filter(coin < F.col("size") * (draws / max(total, 1))).select("key").collect()
    )
    bounds = sorted({drawn[i] for i in range(draws_per_range, len(drawn), draws_per_range)})

    ranged = base.withColumn("range", _range_of(F.col("key"), bounds))
    fair = max(total / n_ranges, 1)
    parts = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"))
        .select("range", F.ceil(F.col("bytes") / (4 * fair)).cast("int").alias("parts"))
    )
    # One row per range, so its size is bounded by n_ranges.
    ranged = ranged.join(F.broadcast(parts), "range").withColumn(
        "part", F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.col("parts")).cast("int")
    )
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("range", "part")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "range",
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    within = Window.partitionBy("range", "part").orderBy("key", "doc_id", "size")
    ends = F.col("bytes_before") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    middle = ends - F.col("size") / 2
    placed = stored(
        ranged.join(F.broadcast(starts), ["range", "part"]).select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.floor(middle * (n_shards / max(total, 1))), F.lit(n_shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.row_number().over(within) - 1).alias("place"),
        )
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
