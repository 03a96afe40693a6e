import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stepwise.session import HOT_ROWS_CONF, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(8, 4, "stepwise-tests", {"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def short_plans(request, spark):
    """Tables of a few rows run faster without whole-stage code; the oracle tests use it."""
    interpret = "test_oracle" not in request.node.nodeid
    spark.conf.set("spark.sql.codegen.wholeStage", str(not interpret).lower())
    yield


@pytest.fixture(params=["plain", "split"])
def skew_mode(request, spark):
    """Run a test with plain windows and again with every group of 3+ rows split."""
    if request.param == "split":
        spark.conf.set(HOT_ROWS_CONF, "3")
    yield request.param
    spark.conf.unset(HOT_ROWS_CONF)
