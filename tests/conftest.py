import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(
        "tests", 8, "6g",
        # Small data: planning and code generation would take longer than the work.
        **{"spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false"},
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-test-")


@pytest.fixture
def lake(spark, folder):
    from ledgerline.sources.tables import Lake

    return Lake(spark, folder)
