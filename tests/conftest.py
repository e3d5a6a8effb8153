import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from depotlens.session import get_spark
    s = get_spark("local[4]", 4, app_name="depotlens-tests",
                  extra={"spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024)})
    s.sparkContext.setLogLevel("ERROR")
    yield s
