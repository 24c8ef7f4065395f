import pytest

from tests.conftest import SF001


@pytest.fixture(scope="session")
def sf():
    return SF001
