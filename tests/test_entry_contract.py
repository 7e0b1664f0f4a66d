"""The driver contract from a fresh process whose working directory is not the repo,
so Python workers only see the package if it is shipped (addPyFile)."""

import os
import subprocess
import sys
import tempfile

SCRIPT = r'''
import importlib.util, sys
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
assert m.entry(spark).count() > 0
q = m.queries()
assert set(m.oracle_sql()) <= set(q)
for name in ("status_transitions", "stream_stateful_merge"):
    assert q[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("CONTRACT-OK")
'''


def test_contract_from_foreign_cwd():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cwd = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT, os.path.join(repo, "__spark_entry__.py")],
                         cwd=cwd, env=env, capture_output=True, text=True, timeout=900)
    assert "CONTRACT-OK" in res.stdout, res.stderr[-3000:]
