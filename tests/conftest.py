import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session

    s = get_session(
        "local[*]",
        app="eventide-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="eventide-test-")},
    )
    yield s
    s.stop()


SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
