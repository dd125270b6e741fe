import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app="logflow-tests", extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
