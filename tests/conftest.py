import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sievekit import get_spark
    ck = tempfile.mkdtemp(prefix="sievekit-test-")
    s = get_spark("sievekit-tests", master="local[4]", shuffle_partitions=8,
                  spark__driver__memory="6g", spark__checkpoint__dir=ck)
    yield s
    s.stop()
