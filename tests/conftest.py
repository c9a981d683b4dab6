import os
import sys

import pytest
from pyspark import cloudpickle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from corpusloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "corpusloom-tests", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def pytest_collection_modifyitems(items):
    # clients and transports defined in tests travel to the workers with their code
    for module in {item.module for item in items}:
        cloudpickle.register_pickle_by_value(module)
