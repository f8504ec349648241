"""Python workers find the package from any folder, without PYTHONPATH."""

import os
import subprocess
import sys
import textwrap

from cases import SF01

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_operators_run_from_another_folder(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})                 # the driver only
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        from shoplens.llm import decontam, vector_codes
        docs = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id bigint, text string")
        bench = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
        print("hit", sorted(r.n_hit for r in decontam.contamination(docs, bench).collect()))
        vectors = spark.read.parquet("{SF01}/embeddings.parquet").limit(20)
        print("codes", vector_codes.compress(vectors).count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "hit [0, 2]" in done.stdout and "codes 20" in done.stdout, done.stderr[-3000:]
