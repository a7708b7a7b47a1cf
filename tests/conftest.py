import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwise.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tillwise-tests-")
    session = build_session(master="local[*]", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.local.dir": os.path.join(scratch, "local"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
    })
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf001_tables(spark):
    from tillwise.sources.tables import load_tables
    return load_tables(spark, SF001, validate=True)


@pytest.fixture(scope="session")
def duck001():
    from tests.oracle_compare import duck
    return duck(SF001)
