"""Q7-Q10 on ad clicks: blacklist, daily totals, area top ads, last-hour trend.

All functions take a DataFrame of clicks (``ts, area, city, user_id, ads_id``
plus an optional ``event_id`` tie key) and work unchanged on a batch frame or
on one micro-batch inside ``foreachBatch``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import tie_columns
from shoplens.plans.joins import broadcast_rows, maybe_broadcast
from shoplens.session import staged


def with_day(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


def click_position(clicks: DataFrame, epoch_col: str | None = None) -> Column:
    """Sort key of a click: [micro-batch,] event time, then the tie key if any."""
    lead = [F.col(epoch_col)] if epoch_col else []
    return F.struct(*lead, F.col("ts"), *[F.col(t) for t in tie_columns(clicks)])


# --- Q7 ------------------------------------------------------------------------

def user_ad_day_counts(clicks: DataFrame) -> DataFrame:
    return with_day(clicks).groupBy("user_id", "ads_id", "day").agg(F.count(F.lit(1)).alias("n"))


def blacklist(clicks: DataFrame, limit: int) -> DataFrame:
    """Users with at least ``limit`` clicks on one ad in one day.

    The limit is per (user, ad, day), the ban is for the user: the reference's
    rule.  Partial counts are combined map-side, so a hot user costs no more
    than any other key.
    """
    return (user_ad_day_counts(clicks).where(F.col("n") >= int(limit))
            .select("user_id").distinct())


def hot_groups(clicks: DataFrame, limit: int) -> DataFrame:
    """(user, ad, day) groups that reach the limit: one narrow aggregate over the log."""
    return user_ad_day_counts(clicks).where(F.col("n") >= int(limit)).select("user_id", "ads_id", "day")


def blacklist_cutoff(clicks: DataFrame, limit: int, epoch_col: str | None = None, groups: DataFrame | None = None) -> DataFrame:
    """Per blacklisted user, the position of the click that reached the limit.

    That is the ``limit``-th click (by [micro-batch,] time, then tie key) of
    the (user, ad, day) group that reaches it first.  Only clicks of ``groups``
    (``hot_groups`` by default) are ranked; ``row_number() = limit`` gets a
    partial WindowGroupLimit, so a hot group never ships all its rows.
    """
    groups = hot_groups(clicks, limit) if groups is None else groups
    pos = click_position(clicks, epoch_col)
    w = Window.partitionBy("user_id", "ads_id", "day").orderBy(pos)
    ranked = with_day(clicks).join(maybe_broadcast(groups), ["user_id", "ads_id", "day"], "left_semi")
    hits = ranked.withColumn("nth", F.row_number().over(w)).where(F.col("nth") == int(limit))
    return hits.groupBy("user_id").agg(F.min(pos).alias("cutoff"))


def clean_clicks(clicks: DataFrame, limit: int, epoch_col: str | None = None) -> DataFrame:
    """Clicks that pass the blacklist.

    Event-time form (no ``epoch_col``): a user's clicks up to and including
    the one that reaches the limit pass; every later click of that user is
    dropped (any ad, any day).  Clicks of equal time and tie key pass or go
    together (without a tie key: all clicks of the limit click's time pass).
    This is the stream's rule with one click per micro-batch.  With
    ``epoch_col`` (the micro-batch of each click) the cut is per micro-batch, as
    in the stream: the whole batch in which the user reaches the limit passes,
    later batches are dropped.  The set of banned users is the same in both.

    The groups that reach the limit are found first, by one narrow aggregate
    that runs when this function is called: the list is written to the shared
    checkpoint folder, and its real size decides whether it and the cutoffs, at
    most one a group, are broadcast.  The log itself is then only filtered in its
    scan stage; if the list is too large for that, the joins shuffle.
    """
    cols = clicks.columns
    groups = staged(hot_groups(clicks, limit), "hot-groups")
    found = groups.count()
    cut = blacklist_cutoff(clicks, limit, epoch_col, groups)
    cut = broadcast_rows(cut, found)
    j = clicks.join(cut, "user_id", "left")
    if epoch_col:
        passed = F.col(epoch_col) <= F.col("cutoff")[epoch_col]
    else:
        passed = click_position(clicks) <= F.col("cutoff")
    return j.where(F.col("cutoff").isNull() | passed).select(*cols)


# A blocked Bloom filter: a key sets some bits of one block.  Spark's bitmaps are
# 4096 bytes, so the filter holds at most this many blocks of that size.
_BLOCK_BITS = 32768
MAX_BLOCKS = 4096               # 16 MB


def _bits_of(key: Column) -> tuple[Column, list[Column]]:
    """(hash of the block, bit numbers in the block) of a key."""
    h = F.xxhash64(key, F.lit(1))
    return F.xxhash64(key), [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(_BLOCK_BITS - 1)).cast("bigint") for i in range(3)]


def key_filter(keys: DataFrame, column: str, blocks: int = MAX_BLOCKS) -> DataFrame:
    """Bloom filter of a key column: block, bits; at most ``blocks`` rows of 4 kB, built by one mergeable aggregate."""
    block, bits = _bits_of(F.col(column))
    each = keys.select(F.pmod(block, F.lit(int(blocks))).alias("block"), F.explode(F.array(*bits)).alias("bit"))
    return each.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_hold(rows: DataFrame, column: str, keys: DataFrame, blocks: int = MAX_BLOCKS) -> DataFrame:
    """``rows`` with ``maybe``: false only if the key is none of those ``key_filter`` was built from."""
    block, bits = _bits_of(F.col(column))
    # One byte of the bitmap as a number, then the bit of it.
    byte = lambda b: F.conv(F.hex(F.substr(F.col("bits"), (F.floor(b / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = [F.getbit(byte(b), (b % 8).cast("int")) == 1 for b in bits]
    all_set = reduce(lambda x, y: x & y, is_set)
    held = F.broadcast(key_filter(keys, column, blocks))
    joined = rows.withColumn("block", F.pmod(block, F.lit(int(blocks)))).join(held, "block", "left")
    return joined.withColumn("maybe", F.coalesce(all_set, F.lit(False))).drop("block", "bits")


def drop_blacklisted(clicks: DataFrame, users: DataFrame, max_bytes: int | None = None, rows: int | None = None) -> DataFrame:
    """Clicks of users not on the list (anti join; the list is re-read per batch).

    A list that passes the size check is broadcast; with ``rows``, a counted bound on
    its users, that many rows are checked and not the size of its files.  A longer one is first met as a
    Bloom filter of bounded size: clicks it rules out pass in their scan stage, and
    only the clicks it can't rule out (those of banned users and a few others) are
    shuffled for the exact anti join.
    """
    small = maybe_broadcast(users, max_bytes) if rows is None else broadcast_rows(users, rows, max_bytes)
    if small is not users:
        return clicks.join(small, "user_id", "left_anti")
    tested = may_hold(clicks, "user_id", users)
    passed = tested.where(~F.col("maybe")).drop("maybe")
    unsure = tested.where(F.col("maybe")).drop("maybe")
    return passed.unionByName(unsure.join(users.hint("merge"), "user_id", "left_anti")).select(*clicks.columns)


# --- Q8 / Q9 ---------------------------------------------------------------------

def ads_per_day(clicks: DataFrame) -> DataFrame:
    """Clicks per (day, area, city, ad)."""
    return with_day(clicks).groupBy("day", "area", "city", "ads_id").agg(
        F.count(F.lit(1)).alias("n"))


def area_top_ads(per_day: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` ads per (day, area) from the daily city totals; ties by ad id."""
    area = per_day.groupBy("day", "area", "ads_id").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("day", "area").orderBy(F.desc("n"), F.asc("ads_id"))
    return (area.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= int(k))
            .select("day", "area", "ads_id", "n", "rn"))


def area_top_ads_json(top: DataFrame) -> DataFrame:
    """Per (day, area) the top list as JSON ``[{"ad":n},...]`` in rank order.

    Each group holds at most ``k`` rows (the result of ``area_top_ads``).
    """
    items = F.array_sort(F.collect_list(F.struct("rn", "ads_id", "n")))
    as_json = F.to_json(F.transform(items, lambda x: F.create_map(x["ads_id"].cast("string"), x["n"])))
    return top.groupBy("day", "area").agg(as_json.alias("ads_json"))


# --- Q10 -----------------------------------------------------------------------

def minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (ad, minute ``m``) over all time."""
    return (clicks.select("ads_id", F.date_trunc("minute", F.col("ts")).alias("m"))
            .groupBy("ads_id", "m").agg(F.count(F.lit(1)).alias("n")))


def minutes_up_to_latest(per: DataFrame, minutes: int = 60) -> DataFrame:
    """The (ad, minute) counts of the last ``minutes`` whole minutes up to the latest one."""
    latest = per.agg(F.max("m")).scalar()
    return per.where(F.col("m") > F.timestamp_add("MINUTE", F.lit(-int(minutes)), latest))


def recent_minutes(clicks: DataFrame, minutes: int = 60, as_of=None) -> DataFrame:
    """Clicks per (ad, minute) over the last ``minutes`` whole minutes.

    The hour is anchored at the minute of the latest click seen: minute >
    latest minute - ``minutes``.  Clicks after ``as_of`` (a timestamp column or
    literal) are left out, so that one misdated click can't move the hour.
    The latest minute is a scalar subquery over the counts per (ad, minute).  It and
    the cut of the hour both read the count as well: neither can be moved below
    the counts, so main query and subquery are one scan and one exchange.
    The reference slides a processing-time window instead; an event-time anchor
    gives the same rows on replay (see ``sliding_hour`` for the sliding form).
    """
    if as_of is not None:
        clicks = clicks.where(F.col("ts") <= as_of)
    per = minute_counts(clicks)
    counted = F.when(F.col("n") > 0, F.col("m"))
    latest = per.agg(F.max(counted)).scalar()
    return per.where(counted > F.timestamp_add("MINUTE", F.lit(-int(minutes)), latest))


def _window(ts, minutes: int, seconds: int | None = None) -> Column:
    return F.window(ts, f"{int(minutes)} minutes", f"{int(seconds)} seconds") if seconds else F.window(ts, f"{int(minutes)} minutes")


def pane_counts(clicks: DataFrame, seconds: int = 10, *keys: str) -> DataFrame:
    """Clicks per (ad[, keys], pane): panes of ``seconds``, the common parts of all sliding windows."""
    return clicks.groupBy(F.window("ts", f"{int(seconds)} seconds").alias("pane"), "ads_id", *keys).agg(F.count(F.lit(1)).alias("n"))


def sliding_hour(clicks: DataFrame, minutes: int = 60, seconds: int = 10) -> DataFrame:
    """The sliding window as a step function: ads_id, window_end (text), n.

    Windows of ``minutes`` end every ``seconds``; ``n`` is the ad's clicks in the
    window that ends at ``window_end`` (excluded).  There is a row for each window
    end at which a pane with clicks of the ad enters or leaves; up to the ad's next
    row every window has the same count, so the rows tell all windows.

    A pane enters at its end and leaves a window's length later, so it is touched
    twice instead of once a window.  Each (ad, stretch of a window's length) is
    summed on its own: it begins with the total of the stretch before, whose panes
    are those that leave in it.  No task holds more than two panes' changes a slide.
    """
    length = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    panes = pane_counts(clicks, seconds).select("ads_id", F.col("pane.end").alias("e"), "n")
    panes = panes.withColumn("b", _window("e", minutes)["start"])
    change = lambda b, t, n, real: F.struct(b.alias("b"), t.alias("t"), n.alias("d"), F.lit(real).alias("real"))
    b, e, n = F.col("b"), F.col("e"), F.col("n")
    changes = panes.select("ads_id", F.inline(F.array(
        change(b, e, n, 1), change(b + length, b + length, n, 0), change(b + length, e + length, -n, 1))))
    per = changes.groupBy("ads_id", "b", "t").agg(F.sum("d").alias("d"), F.max("real").alias("real"))
    upto = Window.partitionBy("ads_id", "b").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.withColumn("n", F.sum("d").over(upto)).where("real = 1").select(
        "ads_id", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "n")


def sliding_minutes(clicks: DataFrame, minutes: int = 60, seconds: int = 10) -> DataFrame:
    """Every sliding window in full: window_end, ads_id, minute ``m``, n.

    Counts per pane come first, so a window merges panes, not clicks.  Works on a
    batch frame and, with a watermark on ``ts``, on a stream in append mode, where
    panes and windows are Spark's window state and a window's rows appear once,
    when the watermark has passed its end.
    """
    panes = pane_counts(clicks.withColumn("m", F.date_trunc("minute", F.col("ts"))), seconds, "m")
    at = F.window_time("pane") if clicks.isStreaming else F.col("pane.start")
    hours = panes.groupBy(_window(at, minutes, seconds).alias("hour"), "ads_id", "m").agg(F.sum("n").alias("n"))
    return hours.select(F.col("hour.end").alias("window_end"), "ads_id", "m", "n")


def last_hour_trend(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """Rows ``ads_id, minute ('yyyy-MM-dd HH:mm'), n`` for the last hour."""
    return recent_minutes(clicks, minutes).select(
        "ads_id", F.date_format("m", "yyyy-MM-dd HH:mm").alias("minute"), "n")


def minute_counts_json(per_minute: DataFrame) -> DataFrame:
    """Per ad, JSON ``[{"HH:mm":n},...]`` in time order (at most 60 items)."""
    items = F.array_sort(F.collect_list(F.struct("m", "n")))
    as_json = F.to_json(F.transform(
        items, lambda x: F.create_map(F.date_format(x["m"], "HH:mm"), x["n"])))
    return per_minute.groupBy("ads_id").agg(as_json.alias("minutes_json"))


def last_hour_json(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    return minute_counts_json(recent_minutes(clicks, minutes))
