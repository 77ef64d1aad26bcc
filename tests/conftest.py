import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starweave.session import build_session, checkpoint_root

    s = build_session("local[*]", app_name="starweave-tests", shuffle_partitions=8)
    checkpoint_root(s)  # uses spark.checkpoint.dir; creates a temp one only if unset
    yield s
    s.stop()
