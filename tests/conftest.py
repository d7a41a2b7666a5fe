import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from keepwell.session import local_session
    session = local_session("4", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def lake(spark):
    from keepwell.plans.lake import Lake
    return Lake(spark, SMALL)
