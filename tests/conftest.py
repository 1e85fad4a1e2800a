import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakeframe.session import local_session

    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    s = local_session(cores=4, extra={"spark.sql.shuffle.partitions": "8", "spark.sql.warehouse.dir": warehouse})
    yield s
    from lakeframe.session import drop_temporary

    drop_temporary(s)
    s.stop()
