import pytest

from rulestream.llm.common import importable


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    importable(spark)
