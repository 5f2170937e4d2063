import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeline.session import build_session

    s = build_session("local[*]", 8, "lakeline-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeline-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from lakeline.plans.tables import Tables

    return Tables(spark, SF001)
