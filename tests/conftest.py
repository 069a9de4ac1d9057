import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sillage.session import get_session, shared_dir

    s = get_session("local[*]", 8)
    shared_dir(s)
    yield s


@pytest.fixture(autouse=True)
def own_settings():
    """A command run without a master sets the running session up for a cluster (8,000
    shuffle partitions); the tests after it get the former settings back."""
    from pyspark.sql import SparkSession

    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    session = SparkSession.getActiveSession()
    before = {n: session.conf.get(n, None) for n in names} if session else {}
    yield
    for n, v in before.items():
        session.conf.unset(n) if v is None else session.conf.set(n, v)


@pytest.fixture(scope="session")
def duck():
    from tests.oracle_compare import duck as make

    return make(SMALL)
