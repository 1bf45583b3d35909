"""The shared folder, in a process of its own with a configuration folder of its own."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROGRAM = """
import sys
from lectern.session import CHECKPOINT_DIR, local_session, shared_dir, stage
spark = local_session("1", 1, "1g", warehouse=sys.argv[1])
assert spark.conf.get(CHECKPOINT_DIR, None) == (sys.argv[2] or None)
stored = stage(spark.range(7), "numbers")
assert stored.count() == 7 and stored.inputFiles()[0].startswith("file:")
print(shared_dir(spark))
"""


def run(folder=""):
    conf, warehouse = tempfile.mkdtemp(prefix="lectern-test-"), tempfile.mkdtemp(prefix="lectern-test-")
    if folder:
        with open(f"{conf}/spark-defaults.conf", "w") as file:
            file.write(f"spark.checkpoint.dir {folder}\n")
    env = {**os.environ, "SPARK_CONF_DIR": conf, "PYTHONPATH": ROOT}
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM, warehouse, folder], env=env, cwd=warehouse, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return warehouse, done.stdout.split()[-1]


def test_below_the_warehouse_where_nothing_is_set():
    warehouse, folder = run()
    assert folder.endswith(f"{warehouse}/lectern-stage")


def test_the_folder_that_is_set():
    chosen = tempfile.mkdtemp(prefix="lectern-test-")
    _, folder = run(chosen)
    assert folder == chosen
