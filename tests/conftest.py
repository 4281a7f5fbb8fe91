import pytest

from strataloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = local_session(8, "tests", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield spark
    spark.stop()
