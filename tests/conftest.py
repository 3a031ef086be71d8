import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marlstone.session import local_session

    session = local_session(cpus=8, shuffle_partitions=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
