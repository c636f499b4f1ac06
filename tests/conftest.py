import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from alertflow.session import build_session
    ckpt = tempfile.mkdtemp(prefix="alertflow-test-ckpt-")
    s = build_session("local[4]", 4, app_name="alertflow-tests",
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()
