"""Submitted settings win over the library's."""

import os
import subprocess
import sys

CODE = """
from panelrank.session import get_spark
s = get_spark("local[1]", shuffle_partitions=8)
print("GOT", s.conf.get("spark.sql.shuffle.partitions"), s.conf.get("spark.sql.adaptive.skewJoin.enabled"), s.conf.get("spark.ui.enabled"))
"""


def test_submitted_settings_win():
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=777 --conf spark.sql.adaptive.skewJoin.enabled=false --driver-memory 1g pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", CODE], env=env, capture_output=True, text=True, timeout=120, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "GOT 777 false false" in run.stdout, run.stdout + run.stderr[-500:]
