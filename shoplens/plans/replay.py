"""The stream jobs over a table of ad clicks, for the registered stream queries.

The clicks are written as ad lines into a source folder, a stretch of the month at a
time, and the stream queries are started again after each: every start continues
from the checkpoints and takes what is new as one micro-batch.  The results are
those of the stream itself: bans act from the next stretch on, totals run on over
all of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.params import Conditions
from shoplens.session import checkpoint_path, ensure_dir
from shoplens.sources.adlog import format_ad_lines, read_ad_stream
from shoplens.sources.tables import ShopTables
from shoplens.streaming.pipeline import AdsStreamJob
from shoplens.streaming.realtime import run_realtime

STRETCH_DAYS = 8        # days of a month that arrive together: four stretches
WAIT_SECONDS = 3600
# A task of a stateful query reports on every state store of the query, so the driver
# gets the square of their number; the totals and minutes they hold are few.
STATE_PARTITIONS = 16

_DONE: dict[tuple, AdsStreamJob] = {}


def stretch(ts: Column) -> Column:
    """The stretch a click arrives in: whole days, 0 to 3."""
    return F.floor((F.dayofmonth(ts) - 1) / STRETCH_DAYS)


def replay(spark: SparkSession, tables: ShopTables, c: Conditions) -> AdsStreamJob:
    """Run the stream over all ad clicks of the tables, stretch by stretch."""
    root = checkpoint_path(spark, "shoplens-replay", uuid.uuid4().hex[:12])
    source = f"{root}/lines"
    ensure_dir(spark, source)
    stores = min(STATE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    job = AdsStreamJob(spark, root=f"{root}/job", limit=c.blacklist_limit, top_k=c.top_ads, minutes=c.window_minutes, state_partitions=stores)
    clicks = tables.ads_click()
    for k in range(-(-31 // STRETCH_DAYS)):
        lines = format_ad_lines(clicks.where(stretch(F.col("ts")) == k))
        lines.write.text(f"{source}/stretch={k}")
        run_realtime(job, read_ad_stream(spark, f"{source}/*"), wait_seconds=WAIT_SECONDS)
    return job


def replayed(spark: SparkSession, tables: ShopTables, c: Conditions) -> AdsStreamJob:
    """``replay``, once a session and input (the kind of tables and where they are)."""
    place = tuple(sorted((k, v) for k, v in vars(tables).items() if isinstance(v, str)))
    at = (spark.sparkContext.applicationId, type(tables).__name__, place, c)
    if at not in _DONE:
        _DONE[at] = replay(spark, tables, c)
    return _DONE[at]


def clean_lines(job: AdsStreamJob) -> DataFrame:
    return job.clean_batch().select(F.unix_millis("ts").alias("ts_ms"), "area", "city", "user_id", "ads_id")
