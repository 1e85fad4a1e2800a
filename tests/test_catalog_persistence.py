"""A table created in one process is visible from a new process on the same metastore."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, {repo!r})
from lakeframe.session import catalog_session
spark = catalog_session({wh!r}, {ms!r}, cores=2)
if {step!r} == "create":
    spark.sql("CREATE DATABASE IF NOT EXISTS depot")
    spark.sql("USE depot")
    spark.createDataFrame([(7, "crane", 1.5), (8, "lift", 0.5)], "id int, tool string, tons double") \
        .write.mode("append").format("parquet").saveAsTable("depot.tools")
else:
    names = [r.namespace for r in spark.sql("SHOW DATABASES").collect()]
    n = spark.sql("SELECT * FROM depot.tools").count()
    print("RESULT", "depot" in names, n)
spark.stop()
"""


def test_metastore_survives_restart(tmp_path):
    wh, ms = str(tmp_path / "warehouse"), str(tmp_path / "metastore")
    outs = []
    for step in ("create", "read"):
        code = SCRIPT.format(repo=REPO, wh=wh, ms=ms, step=step)
        res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                             cwd=str(tmp_path))
        assert res.returncode == 0, res.stderr[-2000:]
        outs.append(res.stdout)
    assert "RESULT True 2" in outs[1]
