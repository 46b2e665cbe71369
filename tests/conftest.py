import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("4", **{"spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a DataFrame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def no_broadcast(spark):
    """As if every table were too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
