import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tools"), os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep)

from stockroute.session import build_session, scratch_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8)
    scratch_root(s)  # registers a local checkpoint folder only when none is configured
    yield s
    s.stop()


@pytest.fixture
def rows():
    def _rows(df, *cols):
        cols = cols or df.columns
        return [tuple(r[c] for c in cols) for r in df.collect()]
    return _rows
