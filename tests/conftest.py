import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TALLY_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tallyspark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def con(sf_dir):
    from oracle_harness import duck

    return duck(sf_dir)
