from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from retentio.session import local_session
    s = local_session("*", shuffle_partitions=8, app_name="retentio-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def members_small(spark):
    from retentio.sources.members import member_table
    return member_table(spark, SF0001).cache()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
