import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from patchloom.session import STREAM_SETTINGS, build_session

    # tests have no cluster to name a shared folder, so they set their own
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    settings = {"spark.checkpoint.dir": folder, **STREAM_SETTINGS}
    session = build_session("tests", master="local[*]", **settings)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL
