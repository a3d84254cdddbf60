import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contactflow.session import local_session  # noqa: E402

# Test modules build columns at import, which needs a running session.
SESSION = local_session(cpus="4", partitions="4")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
