"""Workers get the package's code wherever they are started."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from velomart.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
from velomart.llm.jaccard_join import JaccardJoin
docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
assert {{r.component_id for r in JaccardJoin(docs).components().collect()}} == {{1}}
"""


def test_package_need_not_be_on_the_workers_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, check=True, timeout=300, capture_output=True)
