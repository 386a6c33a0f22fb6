"""What several operators need: folds, stored tables, batches of texts."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The space characters that part words, and A-Z with their small letters.
SPACES = b" \t\n\x0b\x0c\r"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"


def fold(doc_id: str | Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id is in fold 0."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % k, F.lit(0))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a new temporary folder where that is unset and Spark is one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ledgerloom-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces_of(texts: pa.Array, most: int = 4_000_000) -> Iterator[list[str]]:
    """The texts of a batch, null as empty, in lists of about ``most`` characters at most.

    No text is cut: a longer one is a list of its own.
    """
    out: list[str] = []
    size = 0
    for text in texts.to_pylist():
        text = text or ""
        if out and size + len(text) > most:
            yield out
            out, size = [], 0
        out.append(text)
        size += len(text)
    if out:
        yield out


def share(spark: SparkSession, make: Callable, *args) -> Broadcast:
    """Broadcast of something that every Python worker makes once, by ``make(*args)``."""
    return spark.sparkContext.broadcast([cloudpickle.dumps((make, args))])


def shared_value(shared: Broadcast):
    """What ``share`` was asked to make; kept in place of its recipe for the worker's later tasks."""
    held = shared.value
    if len(held) == 1:
        make, args = pickle.loads(held[0])
        held[:] = [None, make(*args)]
    return held[1]


def same(x):
    return x
