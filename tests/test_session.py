import os
import subprocess
import sys
from pathlib import Path

import pytest

from casegrain import session

ROOT = Path(__file__).resolve().parents[1]


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return Conf()

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815

    with pytest.raises(RuntimeError, match="share"):
        session.work_dir(Session())


def test_tables_go_with_the_session(spark):
    store = session.Tables(spark, "gone")
    kept = store.keep(spark.range(5), "t")
    place = Path(store.root.removeprefix("file:"))
    assert kept.count() == 5 and place.exists()
    session.clean_up()
    assert not place.exists()


@pytest.mark.parametrize("stopped", [False, True])
def test_tables_go_with_the_process(tmp_path, stopped):
    code = f"""
from casegrain.session import Tables, get_session
s = get_session("t", "local[1]", 1)
s.sparkContext.setCheckpointDir("file://{tmp_path}/shared")
print(Tables(s, "x").keep(s.range(3), "t").count())
{"s.stop()" if stopped else ""}
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=ROOT, env={**os.environ, "PYTHONPATH": str(ROOT)}, check=True)
    assert out.stdout.strip().endswith("3") and not list((tmp_path / "shared").rglob("*casegrain*"))
