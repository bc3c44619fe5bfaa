from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from headway.session import local_session

    session = local_session(cores=8, memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.01")
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)
