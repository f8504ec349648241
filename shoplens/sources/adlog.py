"""Ad-click log lines: parser (S6) and stream sources (S5).

A line is ``ts area city user ad`` separated by single spaces, ``ts`` in epoch
milliseconds; further fields are ignored, and area, city, user and ad are text
of any form.  The reference splits on one space and fails the whole batch on
fewer than five fields or a ts that is no number; here such a line gets a
``reason`` and goes to a quarantine output while the stream goes on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLICK_COLUMNS = ["ts", "area", "city", "user_id", "ads_id"]

# Epoch milliseconds of the years 1 to 9999, the range of a timestamp.
MIN_TS_MS, MAX_TS_MS = -62_135_596_800_000, 253_402_300_799_999


def parse_ad_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse lines into clicks; adds ``is_valid`` and ``reason``, keeps ``value``.

    Other input columns (e.g. Kafka metadata) are carried through.

    Valid: five fields or more after trailing spaces are cut (an inner empty
    field is an empty text) and an integral ``ts`` inside years 1 to 9999.
    The timestamp is only built from a ts in range, so no line can fail the job.
    """
    raw = F.col(column)
    parts = F.split(F.regexp_replace(raw, " +$", ""), " ")
    field = lambda i: F.try_element_at(parts, F.lit(i))
    ts_ms = F.when(field(1).rlike("^[+-]?[0-9]+$"), field(1).try_cast("bigint"))
    in_range = ts_ms.between(MIN_TS_MS, MAX_TS_MS)
    reason = (F.when(raw.isNull(), "null line")
              .when(F.size(parts) < 5, "fewer than 5 fields")
              .when(~field(1).rlike("^[+-]?[0-9]+$"), "bad ts")
              .when(ts_ms.isNull() | ~in_range, "ts out of range"))
    passthrough = [c for c in lines.columns if c != column and c not in ("value", *CLICK_COLUMNS)]
    return lines.select(
        *passthrough,
        raw.alias("value"),
        F.timestamp_millis(F.when(in_range, ts_ms)).alias("ts"),
        field(2).alias("area"),
        field(3).alias("city"),
        field(4).alias("user_id"),
        field(5).alias("ads_id"),
        reason.alias("reason"),
    ).withColumn("is_valid", F.col("reason").isNull())


def valid_clicks(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("is_valid")).select(*CLICK_COLUMNS)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("is_valid")).select("value", "reason")


def format_ad_lines(clicks: DataFrame) -> DataFrame:
    """Clicks -> wire lines (used to replay a table as a stream).

    The wire format separates fields by single spaces, so a space inside a
    text field (an area such as "MIDDLE EAST") is written as ``_``.
    """
    text = lambda c: F.regexp_replace(F.col(c), " ", "_")
    return clicks.select(F.concat_ws(
        " ", F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), text("area"), text("city"),
        text("user_id"), text("ads_id")).alias("value"))


def read_ad_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines from text files landing in ``path``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


def read_kafka_ad_stream(spark: SparkSession, servers: str, topic: str = "ads_log",
                         starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines from a Kafka topic (needs the spark-sql-kafka package).

    Offsets are tracked in the query checkpoint, not auto-committed to the
    consumer group, so a restarted query resumes exactly where it stopped.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    return r.load().select(F.col("value").cast("string").alias("value"))
