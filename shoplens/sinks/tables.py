"""Batch sinks (K1-K4, K9): every write is one distributed Spark write.

The reference inserts rows one statement at a time from the driver after a
``collect``; here results go straight from the executors to the target.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_task_id() -> str:
    """Run id stamped on every result row of one batch run (K9)."""
    return str(uuid.uuid4())


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    return df.select(F.lit(task_id).alias("task_id"), *df.columns)


def save_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: list[str] | None = None) -> None:
    """Write a result as a table (K1).

    ``target`` containing a ``/`` or ``:`` is a path, anything else a catalog
    table name (``saveAsTable``).
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target or ":" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def save_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
              properties: dict | None = None, num_partitions: int | None = None) -> None:
    """Append a result to a JDBC table with named columns (K2-K4).

    Each executor task opens its own connection and inserts in batches
    (``batchsize``); ``num_partitions`` caps concurrent connections.  Errors
    raise instead of being printed and swallowed.
    """
    opts = {"url": url, "dbtable": table, "batchsize": "1000"}
    if num_partitions:
        opts["numPartitions"] = str(int(num_partitions))
    opts.update(properties or {})
    df.write.format("jdbc").options(**opts).mode(mode).save()


def write_bucketed_log(actions: DataFrame, table: str, buckets: int, path: str | None = None,
                       hot: Column | None = None, mode: str = "overwrite") -> None:
    """Store the action log as a catalog table bucketed by session, in folders by date.

    Jobs that group by session (Q1, Q2, Q5) then read their groups without an
    exchange of the log: a bucket is one task's input.  Rows are dealt out by
    bucket before they are written, so a bucket has one file a date; the sessions
    that ``hot`` marks (``pages.hot_sessions``) are dealt out by hour as well.  When
    such a table is read, a hot session is still one task's work: for a log with
    one, read with ``spark.sql.sources.bucketing.enabled=false``, which gives its
    plain splits and exchanges back.
    """
    bucket = F.pmod(F.hash("session_id"), F.lit(int(buckets)))
    spread = F.lit("") if hot is None else F.when(hot, F.substring("action_time", 1, 13)).otherwise("")
    w = (actions.repartition(int(buckets), bucket, spread).write.mode(mode).partitionBy("date")
         .bucketBy(int(buckets), "session_id").sortBy("session_id", "action_time"))
    (w.option("path", path) if path else w).saveAsTable(table)


def write_shop_tables(tables, base: str, mode: str = "overwrite") -> None:
    """Store the shop tables under ``base`` in the layout ``StoredTables`` reads.

    The action log is partitioned by ``date`` so that date bounds prune whole
    folders; the other tables are plain parquet.
    """
    base = base.rstrip("/")
    save_table(tables.user_visit_action(), f"{base}/user_visit_action", mode=mode, partition_by=["date"])
    save_table(tables.user_info(), f"{base}/user_info", mode=mode)
    save_table(tables.city_info(), f"{base}/city_info", mode=mode)
    save_table(tables.product_info(), f"{base}/product_info", mode=mode)
    clicks = tables.ads_click()
    save_table(clicks.withColumn("ts", F.col("ts").cast("timestamp")), f"{base}/ads_click", mode=mode)
