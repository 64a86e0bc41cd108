"""The package is not installed on the workers: sessions started from another folder must work."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
QUERIES = ("op4_quality_rules", "op6_bpe_round_trip", "op7_token_counts", "op10_benchmark_decontamination",
           "op11_hard_negatives", "op12_token_alignment", "op13_main_text")
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as entry
from ticketloom.llm import main_text
main_text.ITERATIONS = 2
for name in {QUERIES!r}:
    print(name, entry.queries()[name](spark, sys.argv[1]).count())
"""


def test_workers_need_no_package(sf, tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, sf], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == list(QUERIES)
