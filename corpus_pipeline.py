"""A corpus from raw documents to packed sequences, one written table after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language, packing, quality_rules, simhash
from ledgerloom.llm.queries import VOCABULARY, table
from ledgerloom.llm.shared import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: those without a letter, or with no clear winner, go."""
    samples = language.fit(docs)
    told = language.predict(docs, samples, "_language")
    return told.filter((F.col("_language.lang_pred") != language.UNKNOWN) & (F.col("_language.score") >= 0.5)).select(
        *docs.columns
    )


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    learned = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, learned, "_rules").filter("_rules.kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one whose id names it.  Rows without an id stay, equal ones once."""
    groups = simhash.near_duplicates(docs, width=3, most=2)
    going = (
        groups.groupBy("doc_id")
        .agg(F.max(F.col("component_id") == F.col("doc_id")).alias("stays"))
        .filter("NOT stays")
        .select("doc_id")
    )
    return docs.join(going, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", rules),
    ("simhash_near_dedup", near_duplicates),
    ("packing", packed),
]

#: Fingerprints, learned rules and retrieval have no SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
