import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import odd  # noqa: E402


@pytest.fixture(scope="session")
def odd_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(odd.rows(), odd.SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    marked = [(3 * place + 1, int(place % 4 != 0), 0) for place in range(80)] + [(None, 1, 0), (4, 0, 1), (4, 1, 1)]
    vectors = f"{folder}/embeddings.parquet"
    spark.createDataFrame(odd.vectors(), odd.VECTORS).repartition(3).write.parquet(vectors)
    schema = "doc_id long, quality int, toxic int"
    spark.createDataFrame(marked, schema).write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], odd.VECTORS).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder
