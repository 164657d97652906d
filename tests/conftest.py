import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="sensorweave-tests-") as folder:
        s = build_session("local[4]", app="sensorweave-tests", shuffle_partitions=4,
                          conf={"spark.checkpoint.dir": folder})
        yield s
        s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="sw-test-")


def rows(df, order=None):
    """Collect as sorted tuples (helper for exact comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))
