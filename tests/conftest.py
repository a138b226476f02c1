import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="tidemark-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    # A fresh folder per test; scratch is left in place (never removed here).
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
