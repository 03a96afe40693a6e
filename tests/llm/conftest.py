import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(autouse=True, scope="session")
def code_on_workers(spark):
    from stepwise.llm.common import ship_code

    ship_code(spark)
