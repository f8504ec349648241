"""Keyed result tables of the stream jobs as appended batches.

Each micro-batch appends the new rows of the keys it changed under
``<path>/batch_id=<n>``; nothing is rewritten.  A folder is written aside and
renamed into place, so readers see it whole or not at all, and a replayed batch
finds its folder and leaves it.  The rename is the commit, so the file system must
rename a folder in one step; stores that copy instead are refused.  The newest row of a key is the one of its
highest batch (or the greatest running total).

``compact`` is the only call that deletes: run it between streams, when no reader
is on the older folders.  It folds all batches but the newest (which may yet be
replayed) into one folder of a negative number, older than any batch, and then
removes what that folder replaces; as merging is idempotent, a stop in between
does no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_COMPACTED = -(1 << 50)     # folder numbers of compacted batches: negative, rising with the batch

# Stores whose rename copies file by file: a reader could meet half a folder.
COPYING_STORES = ("s3", "s3a", "s3n", "gs", "oss", "cos", "swift", "wasb", "wasbs")


def file_system(spark: SparkSession, path: str):
    """(file system of ``path``, Hadoop's Path class); it must rename folders in one step."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() in COPYING_STORES:
        raise ValueError(f"{path}: stream tables need a file system with atomic rename (e.g. HDFS), not {fs.getScheme()}")
    return fs, Path


class AppendedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, partition_by: tuple[str, ...] = (),
                 max_files: int | None = None):
        self.spark, self.path, self.partition_by, self.max_files = spark, path.rstrip("/"), partition_by, max_files
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        self._fs, self._Path = file_system(spark, self.path)

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={int(batch_id)}"

    def has(self, batch_id: int) -> bool:
        return bool(self._fs.exists(self._Path(self._folder(batch_id))))

    def append(self, df: DataFrame, batch_id: int) -> bool:
        """Add the rows of one batch; False when that batch is there already."""
        if self.has(batch_id):
            return False
        aside = f"{self.path}.aside/batch_id={int(batch_id)}"
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if self.max_files:
            rows = rows.coalesce(self.max_files)
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(aside)
        self._fs.mkdirs(self._Path(self.path))
        if not self._fs.rename(self._Path(aside), self._Path(self._folder(batch_id))):
            raise OSError(f"could not move {aside} into place")
        return True

    def read(self, before: int | None = None, upto: int | None = None) -> DataFrame:
        """All rows with their ``batch_id``, optionally of batches ``< before`` or ``<= upto`` only."""
        full = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        if not self._fs.exists(self._Path(self.path)):
            return self.spark.createDataFrame([], full)
        df = self.spark.read.schema(full).parquet(self.path)
        if before is not None:
            df = df.where(F.col("batch_id") < int(before))
        if upto is not None:
            df = df.where(F.col("batch_id") <= int(upto))
        return df

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Fold all batches below the newest into one folder, then delete the folders it replaces."""
        if not self._fs.exists(self._Path(self.path)):
            return
        names = [st.getPath().getName() for st in self._fs.listStatus(self._Path(self.path))]
        batches = sorted(int(n[9:]) for n in names if n.startswith("batch_id="))
        if len(batches) < 3:
            return
        upto = batches[-2]
        if upto < 0:
            return
        target = _COMPACTED + upto
        self.append(merge(self.read(upto=upto)), target)
        for b in batches[:-1]:
            if b != target:
                self._fs.delete(self._Path(self._folder(b)), True)
