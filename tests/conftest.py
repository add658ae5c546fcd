import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewatch.plans.lake import Lake  # noqa: E402
from tidewatch.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def lake(spark, sf_dir):
    return Lake(spark, sf_dir)


def same_rows(a, b):
    """Equal as bags of rows, columns matched by name."""
    left = sorted(map(repr, map(tuple, a.collect())))
    right = sorted(map(repr, map(tuple, b.select(*a.columns).collect())))
    assert left == right, [x for x in zip(left, right) if x[0] != x[1]][:3]
