import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    os.environ.setdefault("TIDEMARK_DRIVER_MEMORY", "4g")
    session = build_session("tests", "local[4]", 4, str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Literal frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(list(data), schema)
