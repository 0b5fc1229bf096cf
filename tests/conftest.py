import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from schemelens.session import build_session
    s = build_session("local[4]", 8, app_name="schemelens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cat01(spark):
    from schemelens.sources.catalog import catalog_for
    return catalog_for(spark, SF01)


@pytest.fixture(scope="session")
def cat001(spark):
    from schemelens.sources.catalog import catalog_for
    return catalog_for(spark, SF001)


@pytest.fixture(scope="session")
def duck01():
    from harness import duck
    return duck(SF01)
