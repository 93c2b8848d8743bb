import pytest

from tests_llm_data import DOC_SCHEMA, documents


@pytest.fixture()
def docs(spark):
    return lambda rows: spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def corpus():
    return documents()
