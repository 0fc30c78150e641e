import os

import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def spark():
    from concordat.session import local_session

    session = local_session(4, 4)
    yield session
    session.stop()
