import pytest

from tickwarden.llm import common


@pytest.fixture(autouse=True)
def ready(spark):
    common.ready(spark)
