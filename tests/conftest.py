import pytest

from tests.support import make_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session(str(tmp_path_factory.mktemp("spark")), cores="4")
    yield session
    session.stop()
