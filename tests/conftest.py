import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import checkpoint_root, local_session

    s = local_session("*", shuffle_partitions=8, app="marketlake-tests")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marketlake-test-ckpt-"))
    checkpoint_root(s)
    yield s


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
