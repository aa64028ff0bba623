import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from tallyhouse.session import local_session

    session = local_session(4, "4g", "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ctx():
    from tallyhouse.context import RunContext

    return RunContext(datetime(2023, 7, 21, 6), "run-1", "customer_transactions.csv")
