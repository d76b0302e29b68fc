import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ripecast.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    os.environ["PYSPARK_PYTHON"] = sys.executable
    session = build_session(
        "ripecast-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(scratch / "checkpoints"),
        spark__sql__warehouse__dir=str(scratch / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample():
    return f"{TESTDATA}/sf0.001"
