import os
import sys
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Tests have no cluster to name a shared folder, so they set their own.
    session = local_session(8, **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        "spark.sql.shuffle.partitions": "4",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
