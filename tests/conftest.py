import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplayers.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="8g",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
