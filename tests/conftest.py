import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from medallion.session import build_session, workspace

    s = build_session("local[4]", app="medallion-tests", shuffle_partitions=8)
    workspace(s)  # sets a private checkpoint folder only when the cluster gives none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture()
def tmp_ws(spark):
    from medallion.session import scratch

    return scratch(spark, "test")
