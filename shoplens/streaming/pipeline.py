"""Structured Streaming jobs for the ad-click stream (Q7-Q10).

Layout under one shared root folder (a sub-folder of ``spark.checkpoint.dir``
unless given), tables as appended batches (``sinks/appended.py``):

    clean/           clicks that passed the blacklist, with their arrival time
    quarantine/      lines that do not parse
    counters/        clicks per (user, ad, day), a part a day, folded (``sinks/folded.py``)
    bans/            banned users, folded
    results/         ads_per_day, area_top_ads, minute_counts, sliding_hour
    checkpoints/     offsets, commits and state of each query

Queries:

* ``guard``: lines -> parse -> anti join with the users banned by earlier
  micro-batches -> counts per (user, ad, day) added to the stored counters;
  a user whose counter reaches the limit is banned from the next micro-batch
  on, the reference's rule.  One ``foreachBatch`` of DataFrame operations: a
  hot user's clicks are counted by partial aggregates in every task.  A batch
  reads the counters of the days it touches, folded, so its cost does not grow
  with the batches before it.
* ``totals``: clean clicks -> running count per (day, area, city, ad) (Q8) in
  update mode, appended; the top ads of the touched (day, area) groups are
  ranked again from the committed totals (Q9).  State never expires, as in the
  reference.
* ``last_hour``: clean clicks -> count per (minute, ad); the last hour is cut
  when the table is read (Q10).  A click dated more than ``max_ahead`` after its
  arrival counts in Q7-Q9 but not here, where it would push every other click
  out of the hour; ``ahead_clicks`` lists those.
* ``sliding_hour`` (only if started): the reference's sliding window.  Clicks are
  counted in panes of ``slide_seconds`` and panes merged into overlapping windows,
  both in Spark's window state; a window's rows are appended once, when the
  watermark passes its end, so nothing is cut when it is read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import ads
from shoplens.plans.joins import broadcast_rows
from shoplens.session import checkpoint_path, ensure_dir
from shoplens.sinks.appended import AppendedTable
from shoplens.sinks.folded import REST, FoldedTable
from shoplens.sources.adlog import CLICK_COLUMNS, parse_ad_lines

CLEAN = "ts timestamp, area string, city string, user_id string, ads_id string, arrived timestamp"
QUARANTINE = "value string, reason string, arrived timestamp"
COUNTERS = "user_id string, ads_id string, day string, n bigint"
TOTALS = "day string, area string, city string, ads_id string, n bigint"
TOP = "day string, area string, top array<struct<rn: int, ads_id: string, n: bigint>>"
MINUTES = "ads_id string, m timestamp, n bigint"
SLIDING = "window_end timestamp, ads_id string, m timestamp, n bigint"

NAMED_DAYS = 64     # days of a micro-batch that get a part of the counters of their own


def newest_total(rows: DataFrame, *keys: str) -> DataFrame:
    """Running totals only grow, so the greatest is the newest."""
    return rows.groupBy(*keys).agg(F.max("n").alias("n"))


def summed_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "ads_id", "day").agg(F.sum("n").alias("n"))


def newest_top(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day", "area").agg(F.max_by("top", "batch_id").alias("top"))


@dataclass
class AdsStreamJob:
    """The three stream queries over one root folder."""

    spark: SparkSession
    root: str | None = None
    limit: int = 100
    top_k: int = 3
    minutes: int = 60
    trigger: dict | None = None         # e.g. {"processingTime": "5 seconds"}; default availableNow
    clean_max_files: int | None = None  # files of the clean folder per trigger downstream
    write_files: int | None = None      # files a batch writes at most per table
    state_partitions: int | None = None  # state stores of a stateful query; fixed at its first start
    max_ahead: str = "1 hour"           # how far after its arrival a click may be dated in Q10
    slide_seconds: int = 10             # step of the sliding hour
    lateness: str = "1 minute"          # how long the sliding hour waits for late clicks
    fold_every: int = 8                 # batches after which counters and bans are folded
    counter_days: int | None = None     # days the counters are kept after the newest day; default for ever

    def __post_init__(self):
        self.root = (self.root or checkpoint_path(self.spark, "shoplens-ads")).rstrip("/")
        # The downstream file-stream sources need the folder to exist at start.
        ensure_dir(self.spark, self.path("clean"))

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def table(self, name: str) -> AppendedTable | FoldedTable:
        folded = {"fold_every": self.fold_every, "max_files": self.write_files}
        if name == "counters":
            return FoldedTable(self.spark, self.path(name), COUNTERS, summed_counts, part="day", **folded)
        if name == "bans":
            return FoldedTable(self.spark, self.path(name), "user_id string", lambda r: r.distinct(), **folded)
        schema, place = {
            "clean": (CLEAN, "clean"), "quarantine": (QUARANTINE, "quarantine"), "ads_per_day": (TOTALS, "results/ads_per_day"),
            "area_top_ads": (TOP, "results/area_top_ads"), "minute_counts": (MINUTES, "results/minute_counts"),
            "sliding_hour": (SLIDING, "results/sliding_hour")}[name]
        return AppendedTable(self.spark, self.path(place), schema, max_files=self.write_files)

    def _start(self, writer, name: str, stateful: bool = False):
        trig = self.trigger or {"availableNow": True}
        key, conf = "spark.sql.shuffle.partitions", self.spark.conf
        before = conf.get(key)
        if stateful and self.state_partitions:
            # Read once, when the query starts: a stateful query can't change it later.
            conf.set(key, str(int(self.state_partitions)))
        try:
            return (writer.option("checkpointLocation", self.path("checkpoints", name))
                    .queryName(f"shoplens_{name}_{zlib.crc32(self.root.encode()):08x}")
                    .trigger(**trig).start())
        finally:
            conf.set(key, before)

    # -- Q7 ---------------------------------------------------------------------
    def write_guard(self, lines: DataFrame, batch_id: int) -> None:
        """One micro-batch of lines: quarantine, clean clicks, counters, bans.

        Everything depends on the lines and on earlier batches only, and each
        table keeps a batch that it already has, so a replay changes nothing.
        """
        clean, quarantine, counters, bans = (self.table(n) for n in ("clean", "quarantine", "counters", "bans"))
        if bans.has(batch_id):                       # the last table of a batch
            return
        parsed = parse_ad_lines(lines).withColumn("arrived", F.current_timestamp())
        banned = bans.read(before=batch_id)
        parsed = parsed.select("value", "reason", "is_valid", *CLICK_COLUMNS, "arrived").persist()
        try:
            # The list's rows decide whether it is broadcast: its files are packed far smaller than a hash table.
            clicks = ads.drop_blacklisted(parsed.where("is_valid").select(*CLICK_COLUMNS, "arrived"), banned,
                                          rows=bans.stored_rows(before=batch_id))
            quarantine.append(parsed.where("not is_valid").select("value", "reason", "arrived"), batch_id)
            clean.append(clicks, batch_id)
            now = ads.user_ad_day_counts(clicks).persist()
            try:
                days = self._days(now, counters.parts())
                earlier = counters.read(days + [REST], before=batch_id).withColumnRenamed("n", "was")
                # Never broadcast: the counters grow with the days and users, whatever their files' size.  Both sides are grouped by these keys.
                total = now.join(earlier.hint("merge"), ["user_id", "ads_id", "day"], "left").withColumn("n", F.col("n") + F.coalesce("was", F.lit(0)))
                counters.append(now, batch_id, days)
                bans.append(total.where(F.col("n") >= int(self.limit)).select("user_id").distinct(), batch_id)
                if self.counter_days is not None and days:
                    counters.expire(str(date.fromisoformat(days[0]) - timedelta(days=int(self.counter_days))))
            finally:
                now.unpersist()
        finally:
            parsed.unpersist()

    def _days(self, counts: DataFrame, parts: list[str]) -> list[str]:
        """The days of a batch that have a part of the counters or get one, the commonest first.

        A few days hold nearly all clicks of a batch; what is left shares a part.
        """
        per_day = counts.groupBy("day").agg(F.sum("n").alias("n")).withColumn("known", F.col("day").isin(parts))
        found = per_day.orderBy(F.desc("known"), F.desc("n"), "day").limit(len(parts) + NAMED_DAYS).collect()
        new = [r for r in found if not r["known"]][:NAMED_DAYS]
        return [r["day"] for r in sorted([r for r in found if r["known"]] + new, key=lambda r: (-r["n"], r["day"]))]

    def start_guard(self, lines: DataFrame):
        return self._start(lines.writeStream.foreachBatch(self.write_guard), "guard")

    def clean_stream(self) -> DataFrame:
        r = self.spark.readStream.schema(CLEAN + ", batch_id bigint")
        if self.clean_max_files:
            r = r.option("maxFilesPerTrigger", int(self.clean_max_files))
        return r.parquet(self.path("clean")).select(*CLICK_COLUMNS, "arrived")

    def clean_batch(self) -> DataFrame:
        return self.table("clean").read().select(*CLICK_COLUMNS)

    def blacklist_batch(self) -> DataFrame:
        return self.table("bans").read()

    def quarantine_batch(self) -> DataFrame:
        return self.table("quarantine").read().select("value", "reason")

    def _on_time(self, clicks: DataFrame):
        return F.col("ts") <= F.col("arrived") + F.expr(f"INTERVAL {self.max_ahead}")

    def ahead_clicks(self) -> DataFrame:
        """Clean clicks dated too far after their arrival to count in the last hour."""
        rows = self.table("clean").read()
        return rows.where(~self._on_time(rows)).select(*CLICK_COLUMNS, "arrived")

    # -- Q8 / Q9 ------------------------------------------------------------------
    def write_totals(self, updates: DataFrame, batch_id: int) -> None:
        """Append the new running totals, then rank the touched (day, area) groups again.

        ``updates`` holds the new total of every key changed in this micro-batch
        (update mode).  The ranking reads the committed totals.
        """
        totals, top = self.table("ads_per_day"), self.table("area_top_ads")
        totals.append(updates, batch_id)
        if top.has(batch_id):
            return
        known = totals.read(upto=batch_id)
        mine = known.where(F.col("batch_id") == batch_id)
        touched = mine.select("day", "area").distinct()
        # Bounds on the day reach the scan: files of other days are skipped by their statistics.
        first, last, pairs = mine.agg(F.min("day"), F.max("day"), F.count_distinct("day", "area")).first()
        if first is not None:
            known = known.where(F.col("day").between(first, last))
        small = broadcast_rows(touched, pairs)
        touched = touched.hint("merge") if small is touched else small
        state = newest_total(known.join(touched, ["day", "area"], "left_semi"), "day", "area", "city", "ads_id")
        ranked = ads.area_top_ads(state, self.top_k)
        top.append(ranked.groupBy("day", "area").agg(
            F.array_sort(F.collect_list(F.struct("rn", "ads_id", "n"))).alias("top")), batch_id)   # top_k rows a group

    def start_totals(self):
        totals = ads.ads_per_day(self.clean_stream().select(*CLICK_COLUMNS))   # never expires, as in the reference
        w = totals.writeStream.outputMode("update").foreachBatch(self.write_totals)
        return self._start(w, "totals", stateful=True)

    # -- Q10 ----------------------------------------------------------------------
    def write_minutes(self, updates: DataFrame, batch_id: int) -> None:
        self.table("minute_counts").append(updates, batch_id)

    def start_last_hour(self):
        clicks = self.clean_stream()
        per_minute = (clicks.where(self._on_time(clicks))
                      .withWatermark("ts", f"{int(self.minutes)} minutes")
                      .groupBy(F.window("ts", "1 minute").alias("w"), "ads_id")
                      .agg(F.count(F.lit(1)).alias("n"))
                      .select("ads_id", F.col("w.start").alias("m"), "n"))
        w = per_minute.writeStream.outputMode("update").foreachBatch(self.write_minutes)
        return self._start(w, "last_hour", stateful=True)

    def write_sliding(self, rows: DataFrame, batch_id: int) -> None:
        self.table("sliding_hour").append(rows, batch_id)

    def start_sliding_hour(self):
        clicks = self.clean_stream()
        on_time = clicks.where(self._on_time(clicks)).withWatermark("ts", self.lateness)
        rows = ads.sliding_minutes(on_time, self.minutes, self.slide_seconds)
        w = rows.writeStream.outputMode("append").foreachBatch(self.write_sliding)
        return self._start(w, "sliding_hour", stateful=True)

    # -- readers --------------------------------------------------------------------
    def latest(self, name: str) -> DataFrame:
        """Current rows of ``ads_per_day``, ``area_top_ads``, ``area_top_ads_json``, ``last_hour`` or ``last_hour_json``;
        ``sliding_hour`` and ``sliding_hour_json`` are the newest window of the sliding hour."""
        if name == "ads_per_day":
            return newest_total(self.table(name).read(), "day", "area", "city", "ads_id")
        if name.startswith("area_top_ads"):
            top = newest_top(self.table("area_top_ads").read()).select("day", "area", F.explode("top").alias("t")).select(
                "day", "area", "t.ads_id", "t.n", "t.rn")
            return ads.area_top_ads_json(top) if name.endswith("_json") else top
        if name.startswith("sliding_hour"):
            rows = self.table("sliding_hour").read().drop("batch_id")
            newest = rows.where(F.col("window_end") == rows.agg(F.max("window_end")).scalar())
            return ads.minute_counts_json(newest) if name.endswith("_json") else newest
        per = newest_total(self.table("minute_counts").read(), "ads_id", "m")
        recent = ads.minutes_up_to_latest(per, self.minutes)
        return ads.minute_counts_json(recent) if name.endswith("_json") else recent

    def last_hour_trend(self) -> DataFrame:
        return self.latest("last_hour").select("ads_id", F.date_format("m", "yyyy-MM-dd HH:mm").alias("minute"), "n")

    def compact(self) -> None:
        """Fold earlier result and counter batches; to be run while no query of this root is active."""
        self.table("counters").compact()
        self.table("bans").compact()
        self.table("ads_per_day").compact(lambda r: newest_total(r, "day", "area", "city", "ads_id"))
        self.table("area_top_ads").compact(newest_top)
        self.table("minute_counts").compact(lambda r: newest_total(r, "ads_id", "m"))
