import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fleetrisk.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
                            spark__sql__warehouse__dir=str(folder / "warehouse"))
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(folder / "checkpoints"))
    yield session
    session.stop()
