import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from estate.session import get_session, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[8]", 8, app_name="estate-tests")
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)   # tests have no cluster folder: make a local one
    yield s
    s.stop()


@pytest.fixture()
def root(spark):
    from estate.session import fresh_root
    return fresh_root(spark, "test")
