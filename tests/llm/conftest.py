"""Fixtures of the llm tests: Python workers must find the package."""

import pytest

from orderlake.llm.common import importable


@pytest.fixture(autouse=True)
def _importable(spark):
    importable(spark)
