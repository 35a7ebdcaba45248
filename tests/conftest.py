import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tabwright.session import local_session

    session = local_session(8, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    yield session
    session.stop()
