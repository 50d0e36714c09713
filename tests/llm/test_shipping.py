"""The queries where the package is on the driver's path only, as on a cluster without an installed copy."""
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from gridspark.session import local_session
spark = local_session(cores=4, shuffle_partitions=4)
queries = {{k: q for k, q in entry.queries().items() if k.startswith("op") or k == "pipeline"}}
for name, query in queries.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name)
print("all", len(queries))
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "all 14" in done.stdout
