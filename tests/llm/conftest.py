import pytest

from messy_table import SCHEMA, messy_rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def work(spark, tmp_path):
    from recon360.sources.store import TableStore

    return TableStore(spark, str(tmp_path / "llm"))
