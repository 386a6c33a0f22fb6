"""CSV in and out, and where scratch tables go."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case column names; all tables of the lake use them."""
    return df.toDF(*[name.lower() for name in df.columns])


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ","
) -> DataFrame:
    """CSV with a header line.

    Give a schema for large inputs: without one Spark reads the files once more
    only to infer the types.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


#: Column that holds a line which did not fit the schema.
CORRUPT = "_corrupt_line"

# The type of a raw column by the beginning or end of its name, first match.
TYPE_RULES = [
    (r"SK_ID_.*", "bigint"),
    (r"(NAME|CODE|WEEKDAY|FLAG_OWN|FLAG_LAST_APPL|CHANNEL|PRODUCT|STATUS|CREDIT_ACTIVE|CREDIT_CURRENCY|CREDIT_TYPE).*", "string"),
    (r"(OCCUPATION_TYPE|ORGANIZATION_TYPE|FONDKAPREMONT_MODE|HOUSETYPE_MODE|WALLSMATERIAL_MODE|EMERGENCYSTATE_MODE)", "string"),
    (r"(TARGET|FLAG_.*|NFLAG_.*|REG_.*|LIVE_.*|REGION_RATING.*|HOUR_.*|SK_DPD.*|SELLERPLACE_AREA|CNT_CHILDREN|MONTHS_BALANCE)", "int"),
    (r"(NUM_INSTALMENT_NUMBER|DAYS_BIRTH|DAYS_EMPLOYED|DAYS_ID_PUBLISH|DAYS_DECISION|DAYS_CREDIT|DAYS_CREDIT_UPDATE)", "int"),
    (r"(CREDIT_DAY_OVERDUE|CNT_CREDIT_PROLONG)", "int"),
    (r".*", "double"),
]


def type_of_name(name: str) -> str:
    return next(kind for pattern, kind in TYPE_RULES if re.fullmatch(pattern, name, re.IGNORECASE))


def header_schema(spark: SparkSession, path: str, sep: str = ",") -> str:
    """The schema of a raw file by its header line and the rules; no other line is read."""
    first = spark.read.option("header", False).option("sep", sep).csv(path).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    return ", ".join(f"`{name}` {type_of_name(name)}" for name in first)


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ","
) -> DataFrame:
    """CSV by a schema, with lines that do not fit it kept in one more column.

    A header with other names is an error.  A line with too few or too many fields, or a
    value of another type, has its text in ``CORRUPT``.
    """
    text = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    reader = spark.read.option("header", True).option("sep", sep).schema(f"{text}, {CORRUPT} string")
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE", "enforceSchema": False, "columnPruning": False}
    return reader.options(**options).csv(path)


def read_csv_head(
    spark: SparkSession, path: str, n: int, schema: StructType | str | None = None
) -> DataFrame:
    """The first ``n`` rows of a CSV; the scan stops as soon as it has them."""
    return read_csv(spark, path, schema).limit(n)


def export_csv(
    df: DataFrame, path: str, sep: str = ",", n_files: int | None = None, compression: str = "none"
) -> None:
    """CSV with a header line in every file.

    The number of files follows the partitions of ``df`` unless ``n_files`` is
    given; ask for one file only for results known to be small.  A compressed file is
    read by one task, so give large tables many.
    """
    if n_files is not None:
        df = df.repartition(n_files)
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path, compression=compression)


def export_scores(
    df: DataFrame, path: str, id_col: str = "sk_id_curr", score_col: str = "prediction_score"
) -> None:
    """Only the identifier and its score."""
    export_csv(df.select(id_col, score_col), path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark knows."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a temporary table.

    It lies under the shared folder named by ``spark.checkpoint.dir``; a local
    folder is used only where that is unset and the session runs in one process.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to a scratch folder and read back.

    It is computed once, survives lost executors, and its size is known when later joins
    are planned, which broadcast it only if it is small.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
