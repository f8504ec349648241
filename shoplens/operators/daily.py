"""Daily partial results of the batch jobs, merged over any range of days.

Each partial is a mergeable aggregate keyed by the action's day, so a new day is
computed from that day's actions alone and a range is answered from its days'
partials without the log:

* ``session_days``: steps, first and last time of a session's actions of a day;
  a session that runs past midnight has a row a day and is put together again
  by sum, least and greatest;
* ``category_days``: click, order and pay counts per category;
* ``area_days``: clicks per (area, product, city);
* ``page_days``: a session's stretch of a day as a segment (``pages.page_segments``),
  joined to the next day's by its last and first page.

User conditions act on the actions the partials are built from; the date bounds
may be applied to the partials.  ``DailyStore`` keeps them as tables partitioned by
day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import areas, categories, pages, sessions
from shoplens.params import Conditions


def session_days(actions: DataFrame) -> DataFrame:
    """date, session_id, steps, t0, t1."""
    return sessions.session_spans(actions, "date")


def lengths_from_days(days: DataFrame) -> DataFrame:
    """``sessions.session_lengths`` of all days given."""
    return sessions.lengths_of(days.groupBy("session_id").agg(
        F.sum("step_length").alias("step_length"), F.min("t0").alias("t0"), F.max("t1").alias("t1")))


def category_days(actions: DataFrame) -> DataFrame:
    """date, category_id and its click, order and pay counts."""
    return categories.category_counts(actions, "date")


def top_from_days(days: DataFrame, k: int = 10) -> DataFrame:
    """``categories.category_top`` of all days given."""
    return categories.top_counts(categories.merge_counts(days), k)


def area_days(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """date, area, product_id, city_name, n."""
    return areas.area_city_clicks(actions, cities, "date")


def share_from_days(days: DataFrame, c: Conditions) -> DataFrame:
    """``areas.city_share`` of all days given."""
    return areas.share_of_clicks(areas.merge_city_clicks(days), c)


def page_days(actions: DataFrame, c: Conditions) -> DataFrame:
    """date and a session's segment of that day."""
    pairs = pages.flow_pairs(c)
    minutes = pages.page_segments(actions, pairs, "minute")
    return pages.merge_segments(minutes, pairs, F.substring("piece", 1, 10)).withColumnRenamed("piece", "date")


def conversion_from_days(days: DataFrame, c: Conditions) -> DataFrame:
    """``pages.page_conversion`` of all days given."""
    return pages.conversion_from_segments(days.withColumnRenamed("date", "piece"), pages.flow_pairs(c))


class DailyStore:
    """Partials under ``<base>/<name>/date=<day>``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def add(self, name: str, partial: DataFrame) -> None:
        """Write a partial; the days it holds replace what was stored for them, other days stay."""
        (partial.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date").parquet(f"{self.base}/{name}"))

    def read(self, name: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        """The partial of a range of days; the bounds prune the days' folders."""
        df = self.spark.read.parquet(f"{self.base}/{name}")
        if date_from:
            df = df.where(F.col("date") >= F.lit(date_from).cast("date"))
        if date_to:
            df = df.where(F.col("date") <= F.lit(date_to).cast("date"))
        return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
