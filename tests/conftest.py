import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from movelake.session import build_session
    ck = tempfile.mkdtemp(prefix="movelake-test-ckpt-")
    s = build_session("local[4]", app="movelake-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ck, "spark.driver.memory": "4g"})
    yield s
    s.stop()
