import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from minekit.session import local_session

    session = local_session("tests", cores=8, memory="8g")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def tight(spark):
    """Limits so low that every operator takes its path for large groups."""
    from minekit.plans.bounds import BROADCAST_ROWS, GROUP_ROWS

    spark.conf.set(GROUP_ROWS, "40")
    yield spark
    spark.conf.unset(GROUP_ROWS)
    spark.conf.unset(BROADCAST_ROWS)
