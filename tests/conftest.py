import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from scoreloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4, memory="6g")
