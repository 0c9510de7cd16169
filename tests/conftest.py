from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tonemill.session import local_session

    return local_session("tests", cores=8, shuffle_partitions=8)


@pytest.fixture(scope="session")
def sf():
    return SF
