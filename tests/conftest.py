import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # away from the repository: Python workers must not find the package in their folder
    os.chdir(tmp_path_factory.mktemp("cwd"))
    session = local_session(cores="8", memory="4g", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
