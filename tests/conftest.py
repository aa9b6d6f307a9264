import os

import pytest

from slyglot.session import local_session, ship_package

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
