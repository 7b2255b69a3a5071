from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rental_mart.session import drop_scratch, local_session

    s = local_session(cores=4, shuffle_partitions=4)
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_base(spark, tmp_path):
    return str(tmp_path)
