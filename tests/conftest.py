import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from meterlark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SMALL).exists():
        pytest.skip(f"no test data at {SMALL}")
    return SMALL


def pairs(df):
    return sorted(map(tuple, df.collect()), key=repr)
