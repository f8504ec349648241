"""Spark session settings and the shared checkpoint folder.

The jobs need three things from a session: event-time work in UTC, AQE on
(runtime coalescing, skew-join splitting, broadcast conversion from measured
shuffle sizes) and no web UI.  ``build_session`` sets them for tests and the
bench; on a cluster the same keys go into the submit configuration.
"""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; sizes are per-deployment and stay overridable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state (per-user guard rows, running totals) lives in RocksDB on
    # local disk rather than on the JVM heap; changelog checkpointing uploads
    # only the changes of each micro-batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app_name: str = "shoplens", extra: dict | None = None) -> SparkSession:
    """A session with the settings above.

    Tests and the bench pass a local master; under ``spark-submit`` pass
    ``master=None`` and ``shuffle_partitions=None`` so the submit
    configuration decides (AQE then sizes partitions at run time).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is only read here;
    a cluster session without it is an error, because a machine-local folder
    would not survive the loss of the machine.  Only a local-mode session
    (tests, the bench) gets a fresh scratch folder when it is unset.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS)")
        path = tempfile.mkdtemp(prefix="shoplens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder (stream state, snapshots)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts]) if parts else base


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` on whatever file system it names (local, HDFS, object store)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back; removed when the session's JVM ends."""
    spark = df.sparkSession
    path = checkpoint_path(spark, "shoplens-staged", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, whatever their own path: once a Spark context.

    The package's modules go as a zip into the shared checkpoint folder and are added
    from there.  An installed package, or one given by ``--py-files``, is found as well.
    """
    sc, home = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_shoplens_shipped", False) or not os.path.isdir(home):      # not a folder: came as a zip itself
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, names in os.walk(home):
            dirs.sort()
            for name in sorted(n for n in names if n.endswith(".py")):
                inside = os.path.relpath(os.path.join(folder, name), os.path.dirname(home))
                with open(os.path.join(folder, name), "rb") as f:
                    z.writestr(zipfile.ZipInfo(inside.replace(os.sep, "/")), f.read())
    data = packed.getvalue()
    path = checkpoint_path(spark, "shoplens-code", uuid.uuid4().hex[:12], f"shoplens-{hashlib.sha256(data).hexdigest()[:12]}.zip")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(p)
    out.write(bytearray(data))
    out.close()
    fs.deleteOnExit(p.getParent())
    sc.addPyFile(fs.makeQualified(p).toString())
    sc._shoplens_shipped = True
