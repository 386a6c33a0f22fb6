"""Tables of one layer of the lake, addressed by path."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.session import at_once, session_aside
from ledgerloom.sources.files import (
    CORRUPT,
    header_schema,
    lower_names,
    path_exists,
    read_csv_checked,
)


@dataclass(frozen=True)
class Lake:
    """One layer: a base folder and a table format.

    ``fmt`` may be any format Spark has on its class path (``parquet``, ``orc``,
    ``delta``).  Writes always go to a table other than the ones being read.
    """

    spark: SparkSession
    base: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def read(self, name: str, as_of: dt.date | None = None) -> DataFrame:
        """A table, or with ``as_of`` only that ingest partition of it."""
        df = self.spark.read.format(self.fmt).options(**self.options).load(self.path(name))
        return df if as_of is None else df.where(F.col("ingest_date") == F.lit(as_of))

    def replace(
        self,
        df: DataFrame,
        name: str,
        partition_by: Iterable[str] = (),
        only_partitions_written: bool = False,
    ) -> None:
        """Overwrite a table, its schema included.

        With ``only_partitions_written`` the other partitions of the table stay.
        """
        writer = df.write.format(self.fmt).mode("overwrite").options(**self.options)
        if only_partitions_written:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        else:
            writer = writer.option("overwriteSchema", True)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.path(name))

    def replace_rows(self, df: DataFrame, name: str) -> None:
        """Overwrite a table whose schema must not change."""
        if self.exists(name):
            _require_same_columns(self.read(name).schema, df.schema, name)
        df.write.format(self.fmt).mode("overwrite").options(**self.options).save(self.path(name))

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def names(self) -> list[str]:
        """The tables of the layer, found by their folders."""
        jvm = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        system = jvm.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(jvm):
            return []
        found = [s.getPath().getName() for s in system.listStatus(jvm) if s.isDirectory()]
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def create_tables(self, database: str, names: Iterable[str] | None = None) -> list[str]:
        """Make tables of the layer known to the session catalog, by their folders.

        They are external tables: with a metastore they outlive the session, and every
        session sees them by name; dropping one leaves its data.  Tables already there are
        defined anew, so that changed schemas and new partitions are seen.
        """
        names = list(self.names() if names is None else names)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name in names:
            table = f"`{database}`.`{name}`"
            # Read first: a folder that is no table must not replace a definition.
            partitioned = self._partitions(name)
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            location = self.path(name).replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {table} USING {self.fmt} LOCATION '{location}'")
            if partitioned and self.fmt in ("parquet", "orc", "csv", "json"):
                self.spark.catalog.recoverPartitions(f"{database}.{name}")
        return names

    def _partitions(self, name: str) -> bool:
        """Whether the folder of a table holds folders of partitions."""
        files = self.read(name).inputFiles()
        return any("=" in f.rsplit("/", 2)[-2] for f in files[:1])

    def register(self, names: Iterable[str], prefix: str = "") -> None:
        """Make tables of the layer known to ``spark.sql`` under their names."""
        for name in names:
            self.read(name).createOrReplaceTempView(f"{prefix}{name}")


def _require_same_columns(old: StructType, new: StructType, name: str) -> None:
    def shape(schema: StructType):
        return sorted((f.name.lower(), f.dataType.simpleString()) for f in schema.fields)

    if shape(old) != shape(new):
        raise ValueError(f"schema of {name} would change: {shape(old)} to {shape(new)}")


def stamp_ingest(
    df: DataFrame, ingest_date: dt.date | None = None, ingest_timestamp: dt.datetime | None = None
) -> DataFrame:
    """Add the load date and time; give them to make a load repeatable."""
    day = F.lit(ingest_date) if ingest_date else F.current_date()
    moment = F.lit(ingest_timestamp) if ingest_timestamp else F.current_timestamp()
    return df.withColumns({"ingest_date": day, "ingest_timestamp": moment})


@dataclass(frozen=True)
class Loaded:
    """What a load did."""

    table: str
    rows: int
    rejected: int


def ingest_table(
    raw_base: str,
    bronze: Lake,
    name: str,
    ingest_date: dt.date | None = None,
    schema: StructType | str | None = None,
    keep_history: bool = False,
) -> Loaded:
    """One raw CSV to a date-partitioned table of the same name in lower case.

    Types come from ``schema`` or else from the header's names.  The file is read once, and
    its lines are counted on the way.  Lines that do not fit go, with their text, file and
    what could be read of them, to the table ``<name>_rejected``; only where there are such
    lines is the file read again for them.  By default a load replaces
    the table; with ``keep_history`` it replaces only the partition of its own date.
    """
    path = f"{raw_base.rstrip('/')}/{name}.csv"
    spark = session_aside(bronze.spark)
    parsed = read_csv_checked(spark, path, schema or header_schema(spark, path))
    bad = F.col(CORRUPT).isNotNull()
    counts = Observation()
    counted = parsed.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("rejected"))
    table = name.lower()
    how = {"partition_by": ["ingest_date"], "only_partitions_written": keep_history}
    rows = counted.where(~bad).drop(CORRUPT)
    bronze.replace(stamp_ingest(lower_names(rows), ingest_date), table, **how)
    found = counts.get
    if found["rejected"] or (not keep_history and bronze.exists(f"{table}_rejected")):
        # All columns, as those left out would not be checked against their types.
        readable = F.to_json(F.struct(*rows.columns)).alias("readable")
        lines = parsed.where(bad).select(F.col(CORRUPT).alias("line"), F.input_file_name().alias("file"), readable)
        if not found["rejected"]:
            lines = lines.limit(0)
        # Without history the table is one that an empty load can replace, too.
        bronze.replace(stamp_ingest(lines, ingest_date), f"{table}_rejected", **(how if keep_history else {}))
    return Loaded(table, found["lines"] - found["rejected"], found["rejected"])


def ingest_tables(
    raw_base: str,
    bronze: Lake,
    names: Iterable[str],
    ingest_date: dt.date | None = None,
    schemas: Mapping[str, StructType | str] | None = None,
    keep_history: bool = False,
) -> list[Loaded]:
    """Several raw files, some at a time."""
    return at_once(bronze.spark, [
        partial(ingest_table, raw_base, bronze, name, ingest_date, (schemas or {}).get(name), keep_history)
        for name in names
    ])
