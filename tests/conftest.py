import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from basketlens.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "basketlens-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="basketlens-tests-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test tables in {DATA}")
    return DATA


@pytest.fixture(scope="session")
def star(spark, folder):
    from basketlens.sources.mapped import MappedStar

    return MappedStar(spark, folder)
