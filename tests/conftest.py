import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from foretide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session


@pytest.fixture
def tiny_keys(spark):
    """Treat keys with more than 20 rows as hot, in chunks of 7 rows."""
    spark.conf.set("foretide.hot.rows", "20")
    spark.conf.set("foretide.chunk.rows", "7")
    yield
    spark.conf.unset("foretide.hot.rows")
    spark.conf.unset("foretide.chunk.rows")
