from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.compare import duck, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewell.session import configure

    return configure(session())


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def con():
    return duck(SMALL)
