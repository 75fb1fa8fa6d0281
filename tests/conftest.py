import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakehand.session import checkpoint_dir, get_spark
    s = get_spark("lakehand-tests", master="local[4]", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lakehand-wh-")})
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="lakehand-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
