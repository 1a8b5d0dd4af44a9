import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakestrata.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", "lakestrata-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ls-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def lake_root():
    # a fresh scratch folder per test (never cleared, never reused)
    return "file:" + tempfile.mkdtemp(prefix="ls-lake-")


def rows(df, *cols):
    """Collected rows as tuples (optionally a column subset), sorted with None first."""
    data = [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((v is not None, v) for v in t))
