"""The checkpoint folder comes from the session's spark.checkpoint.dir when it is set."""
from __future__ import annotations

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from segmark.session import checkpoint_dir, scratch_path
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
d = checkpoint_dir(spark)
print("DIR", d)
print("SCRATCH", scratch_path(spark, "t"))
spark.stop()
"""


def test_configured_checkpoint_dir_is_used():
    shared = tempfile.mkdtemp(prefix="segmark-shared-")
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO, shared=shared)],
        capture_output=True, text=True, timeout=300,
    ).stdout
    lines = dict(ln.split(" ", 1) for ln in out.splitlines() if ln.startswith(("DIR", "SCRATCH")))
    assert shared in lines["DIR"]
    assert shared in lines["SCRATCH"]


def test_scale_conf_partition_floor():
    from segmark.session import partitions_for, session_conf

    assert partitions_for(10 * 1024**3) == 64  # the floor
    assert session_conf(16)["spark.sql.shuffle.partitions"] == "16"
    assert session_conf()["spark.ui.enabled"] == "false"
