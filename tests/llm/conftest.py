import pytest

from tests.llm import corpus


@pytest.fixture(scope="session")
def rows():
    return corpus.documents()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    from tidewater.llm.common import small_batches

    small_batches(spark)
    path = str(tmp_path_factory.mktemp("corpus") / "documents.parquet")
    spark.createDataFrame(rows, corpus.COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def items(spark, rows):
    return spark.createDataFrame(corpus.items(rows), corpus.ITEMS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], corpus.COLUMNS)
