import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitchlake.session import local_session

    s = local_session("*", shuffle_partitions=8, app="pitchlake-tests")
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return tmp_path
