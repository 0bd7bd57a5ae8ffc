"""Where a session keeps what others must read."""

import subprocess
import sys
from pathlib import Path

import pytest

from calorgrid import session

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
s = SparkSession.builder.master("local-cluster[1,1,512]").config("spark.ui.enabled", "false").config("spark.executor.memory", "512m").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
from calorgrid.session import checkpointed, ship
ship(s)
@F.pandas_udf("string")
def where(x):
    import calorgrid
    import pandas as pd
    return pd.Series([calorgrid.__file__] * len(x))
print(checkpointed(s.range(2).select(where("id").alias("w"))).first()[0])
"""


def test_the_package_comes_from_the_shared_folder(tmp_path):
    out = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {str(ROOT)!r})\n" + SCRIPT, str(tmp_path)], capture_output=True, text=True, timeout=300, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}, cwd=tmp_path)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "calorgrid.zip" in out.stdout.splitlines()[-1] and list(tmp_path.glob("*/calorgrid.zip"))


class Cluster:
    """As much of a session on a cluster as is asked for."""

    master = "spark://somewhere:7077"
    conf = type("Conf", (), {"get": staticmethod(lambda name, default: default)})
    getCheckpointDir = staticmethod(lambda: None)

    @property
    def sparkContext(self):
        return self

    @property
    def sparkSession(self):
        return self


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpointed(Cluster())
