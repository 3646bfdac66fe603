import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamtab.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck001():
    from streamtab.plans.verify import duckdb_conn
    return duckdb_conn(SF001)


@pytest.fixture(scope="session")
def duck01():
    from streamtab.plans.verify import duckdb_conn
    return duckdb_conn(SF01)
