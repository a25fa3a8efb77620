from __future__ import annotations

import pytest
from compare import FOLDER, oracle_connection

from creditloom.plans.catalog import Tables
from creditloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "creditloom-tests", **{"spark.python.sql.dataFrameDebugging.enabled": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    return oracle_connection()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables.of(spark, FOLDER)


@pytest.fixture(scope="session")
def rows(spark):
    """Build a DataFrame from literal rows."""
    return lambda data, schema: spark.createDataFrame(data, schema)
