import pytest


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import local_session

    yield local_session(cpus="*", shuffle_partitions=8, app="riskframe-tests")
