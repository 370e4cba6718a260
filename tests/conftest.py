import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskgraph.session import get_session

    s = get_session("local[4]", 4, app_name="riskgraph-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="rg-test-ckpt-")})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="rg-test-")
