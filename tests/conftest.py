import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lapmart.session import local_session

    wh = tmp_path_factory.mktemp("warehouse")
    s = local_session(8, shuffle_partitions=8, app_name="lapmart-tests",
                      extra_conf={"spark.sql.warehouse.dir": str(wh)})
    yield s
    s.stop()
