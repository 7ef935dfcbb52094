"""Every corpus query and the pipeline on executors that have no copy of the package."""

import os
import pathlib
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
import corpus_pipeline
from veinstone.llm.queries import QUERIES
for name, query in [*QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    if len(sys.argv) > 2 and name not in sys.argv[2:]:
        continue
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


def test_queries_run_without_the_package_on_executors(tmp_path):
    repo = pathlib.Path(__file__).resolve().parents[2]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, str(repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    ran = [x.split()[1] for x in out.stdout.splitlines() if x.startswith("ran ")]
    from veinstone.llm.queries import QUERIES

    assert ran == [*QUERIES, "pipeline"], out.stderr[-3000:]
