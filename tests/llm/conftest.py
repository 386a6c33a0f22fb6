import pandas as pd
import pytest

LONG = "word " * 60_000 + "the end of a long line, and some more of it."


@pytest.fixture(scope="session")
def odd_texts():
    """(doc_id, text): null, empty, blank, long, tied, repeated and strange texts, and a null id."""
    prose = "The old boat lay in the harbour while the rain fell on the quiet town and its people."
    texts = [None, "", "  \n ", LONG, prose, prose, prose + " Again.", "Ünïcödé — 日本語 🙂 text", "a\x00b", "*** $$$ ###"]
    rows = list(enumerate(texts, 1))
    return rows + [(5, prose), (None, prose), (100, "x"), (50, "1 2 3 4 5 6 7 8 9 10 11 12")]


@pytest.fixture(scope="session")
def odd_folder(spark, tmp_path_factory, odd_texts):
    """Tables of odd rows; documents also has columns that operators use inside."""
    folder = str(tmp_path_factory.mktemp("odd"))
    clash = "score int, s string, key string, fp string, range int, part int, mark int, ids string, n int, y int"
    rows = [(i, t, "en" if i and i % 2 else None, f"s{i % 3}" if i else None, *[None] * 10) for i, t in odd_texts]
    spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {clash}").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2 if i < 9 else None, (i + 1) % 2) for i in range(1, 11)] + [(None, 1, 1), (5, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    vectors = [(0, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
               (6, [float("inf"), 0.0]), (7, []), (50, [-1.0, 3.0]), (50, [-1.0, 3.0]), (None, [1.0, 1.0]), (8, [9.0])]
    spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, block int").write.parquet(
        f"{folder}/embeddings.parquet"
    )
    turns = [(i, turn, role, text, 1) for i, text in odd_texts for turn, role in ((1, "assistant"), (0, "user"), (None, None))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, key int").write.parquet(
        f"{folder}/conversations.parquet"
    )
    return folder


@pytest.fixture(scope="session")
def empty_folder(spark, tmp_path_factory, odd_folder):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "conversations"):
        spark.read.parquet(f"{odd_folder}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(small):
    return pd.read_parquet(f"{small}/documents.parquet")
