"""Written tables in the shared checkpoint folder (lineage cut, executor-loss safe)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shoplens.session import checkpoint_path, ship_package


class Staging:
    """Tables of one operator run, in an own sub-folder of ``spark.checkpoint.dir``.

    A written table does not depend on executors that computed it, so a lost
    executor costs the running tasks only.  ``drop`` deletes a table that no
    later step reads; what a lazy result still reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        ship_package(spark)
        self.root = checkpoint_path(spark, "shoplens-llm", f"{name}-{uuid.uuid4().hex[:12]}")
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        path = getattr(df, "_staged_path", None)
        if path:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def keys_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` (bigint) and ``text`` alone: other columns can't clash with an operator's own."""
    ship_package(docs.sparkSession)         # operators go on in Python workers
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
