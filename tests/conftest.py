import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def checkpoint_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("checkpoints"))


@pytest.fixture(scope="session")
def spark(checkpoint_folder):
    session = build_session(
        "tillwise-tests",
        **{
            "spark.master": "local[8]",
            "spark.checkpoint.dir": checkpoint_folder,
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
