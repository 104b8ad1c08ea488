import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.collect()}


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows, extra=""):
        return spark.createDataFrame([(*r, *([7] * extra.count(","))) for r in rows], f"doc_id long, text string{extra}")

    return make
