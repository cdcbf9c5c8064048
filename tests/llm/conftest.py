import pytest


@pytest.fixture(scope="session")
def llm_spark(spark):
    from orderflow.llm.common import prepare

    prepare(spark)
    return spark
