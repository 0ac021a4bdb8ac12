import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ctspark.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=4, app="ctspark-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def psl(spark):
    from ctspark.operators.hosts import PublicSuffixTable

    return PublicSuffixTable(spark, rules=["com", "net", "org", "uk", "co.uk", "*.ck", "!www.ck", "jp", "*.kawasaki.jp", "!city.kawasaki.jp"])
