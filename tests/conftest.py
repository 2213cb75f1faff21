import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plumbline.session import get_spark  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", cores=8, spark__sql__shuffle__partitions="4", spark__driver__memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return TINY
