import pytest

from parcelflow.session import local_session, shared_dir


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    shared_dir(session)
    yield session
    session.stop()
