import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import edges  # noqa: E402


@pytest.fixture(scope="session")
def edge_rows():
    return edges.documents()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, edges.COLUMNS)


@pytest.fixture(scope="session")
def edge_dir(spark, edge_docs, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("edges"))
    edge_docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 1), (1000, None, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="session")
def small_rows(spark, sf):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
