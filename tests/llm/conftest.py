import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def llm(spark):
    from airlane.llm.common import prepare

    return prepare(spark)
