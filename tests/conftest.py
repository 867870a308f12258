from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadpulse.session import checkpoint_dir, local_session

    s = local_session(cpus="*", shuffle_partitions=8, app="roadpulse-tests")
    # the configured spark.checkpoint.dir when set; a scratch folder otherwise
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
