import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        "tests",
        **{
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(shared / "catalog"),
            "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
