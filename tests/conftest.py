import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from casegrain.session import get_session

    s = get_session("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.mktemp('shared')}")
    yield s
    s.stop()
