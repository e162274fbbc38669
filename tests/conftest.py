import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickwarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = local_session("8")
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def chunked(spark):
    """Run a test with tiny chunks so that the cut-up paths are taken."""
    spark.conf.set("spark.tickwarden.chunkRows", "97")
    yield spark
    spark.conf.unset("spark.tickwarden.chunkRows")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
