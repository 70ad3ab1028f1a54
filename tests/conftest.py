import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from rangeload.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions=4,
        spark__default__parallelism=4,
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="rangeload-test-")
