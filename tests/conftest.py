import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from boardlake.session import build_session
    s = build_session("boardlake-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    s.sparkContext.setLogLevel("ERROR")
    # Tests are the one place that may supply a checkpoint folder of their own.
    from boardlake.session import checkpoint_root
    checkpoint_root(s, default=tempfile.mkdtemp(prefix="boardlake-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
