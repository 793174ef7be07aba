"""Settings of a submitted session stay; only a local one gets its own."""

import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})
from shelfcast.session import get_spark
spark = get_spark("t"{asked})
print("GOT", spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
"""


def _run(root, asked):
    env_args = "--master local[3] --conf spark.sql.shuffle.partitions=37 --conf spark.ui.enabled=false pyspark-shell"
    out = subprocess.run(
        [sys.executable, "-c", CODE.format(root=str(root), asked=asked)], capture_output=True, text=True, timeout=120,
        env=os.environ | {"PYSPARK_SUBMIT_ARGS": env_args})
    return next(line for line in out.stdout.splitlines() if line.startswith("GOT"))


def test_submitted_settings_win(request):
    assert _run(request.config.rootpath, "") == "GOT local[3] 37"


def test_local_session_when_asked(request):
    assert _run(request.config.rootpath, ", cpus=2") == "GOT local[2] 2"
