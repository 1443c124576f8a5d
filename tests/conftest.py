import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lapworks.session import build_session
    wh = tempfile.mkdtemp(prefix="lapworks-wh-")
    s = build_session("local[*]", 8, "lapworks-tests", {"spark.sql.warehouse.dir": wh})
    yield s
    from lapworks.plans import suite
    suite.cleanup(s)
    s.stop()
