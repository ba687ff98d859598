import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from greenlane.session import local_session

    s = local_session("4", shuffle_partitions=8, app="greenlane-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def wh_small(spark):
    from greenlane.plans.core import Warehouse
    from greenlane.sources import tpch_tables

    return Warehouse(tpch_tables(spark, SF_SMALL))
