"""Submitted settings stand; a shared folder is needed off the local master."""

import os
import subprocess
import sys

import pytest

from contrail import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_settings_survive(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {REPO!r})
from contrail.session import get_spark
s = get_spark()
print("GOT", s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"),
      s.conf.get("spark.sql.session.timeZone"), s.sparkContext.getConf().get("spark.driver.memory"))
""")
    import pyspark
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_GATEWAY", "PYSPARK_SUBMIT"))}
    out = subprocess.run([submit, "--master", "local[2]", "--driver-memory", "600m", "--conf", "spark.ui.enabled=false",
                          "--conf", "spark.sql.shuffle.partitions=77", "--conf", "spark.sql.session.timeZone=Asia/Tokyo",
                          str(script)], capture_output=True, text=True, timeout=180,
                         env=env | {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable})
    assert "GOT local[2] 77 Asia/Tokyo 600m" in out.stdout, out.stdout + out.stderr[-2000:]


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    def __init__(self, master):
        self.conf = _Conf()
        self.sparkContext = type("C", (), {"master": master, "getConf": lambda self: _Conf()})()


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_no_private_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Session(master))
