import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tickertone import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return get_spark(
        "tests", 8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__shuffle__partitions="4",
    )
