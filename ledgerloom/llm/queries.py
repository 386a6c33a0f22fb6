"""The operators of this package over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    chat,
    ctw,
    divergence,
    language,
    packing,
    quality_net,
    quality_rules,
    sharding,
    simhash,
    topk,
    toxicity,
    whitening,
)
from ledgerloom.llm.shared import fold

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, table(spark, folder, "labels"))
    return quality_rules.judge(docs, rules, "r").select("doc_id", "r.*")


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), "b").select("doc_id", "b.*")


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, folder, "documents"), 24)


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    samples = language.fit(docs.filter(fold("doc_id", 4) != 2))
    return language.predict(docs.select("doc_id", "text"), samples, "p").select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "p.lang_pred", "p.score"
    )


def _marked(df: DataFrame, least: float) -> DataFrame:
    return df.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    net = quality_net.fit(docs, table(spark, folder, "labels").filter(fold("doc_id", 5) != 0))
    return _marked(quality_net.score(docs, net, "score"), 0.3)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels").filter(fold("doc_id", 5) != 0))
    return _marked(toxicity.score(docs, model, "score"), 0.5)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), width=3, most=2)


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), k=5, every=50)


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = ctw.fit(docs.filter(fold("doc_id", 10) != 0))
    return ctw.score(docs, model, 10)


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat.read_back(chat.windows(turns.union(more), public_tokenizers.path(VOCABULARY)))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_bpe,
        op3_sharding,
        op4_language_id,
        op5_quality_classifier,
        op6_packing,
        op7_toxicity,
        op8_simhash,
        op9_topk,
        op10_lm_scoring,
        op11_whitening,
        op12_chat_formatting,
        op13_source_divergence,
    )
}

SQL: dict[str, str] = {
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), pairs AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id,
               (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id, score
        FROM pairs
        QUALIFY rank <= 5
    """,
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), w AS (
            SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), c AS (
            SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM w GROUP BY ALL
        ), k AS (
            SELECT lang, term, sum(n)::BIGINT AS total FROM c GROUP BY ALL HAVING sum(docs) >= 30
        ), v AS (
            SELECT lang, count(*) AS v, sum(total)::BIGINT AS total FROM k GROUP BY ALL
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), s AS (
            SELECT lang, source, sum(n)::BIGINT AS size FROM c JOIN k USING (lang, term) GROUP BY ALL
        ), p AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(s.size, 0) + 5 * v.v) AS p,
                   1 + 1000000000::HUGEINT * (k.total + 5) // (v.total + 5 * v.v) AS q
            FROM g JOIN k USING (lang) JOIN v USING (lang)
            LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
            LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
        ), f AS (
            SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
            FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
        ), r AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
        )
        SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
        FROM r QUALIFY part = 'pair' OR rank <= 50
    """,
}
