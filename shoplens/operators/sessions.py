"""Q1 session statistics and Q2 proportional session sample.

Sessions are built with aggregates, never by gathering a session's rows in
one place: lengths are ``min`` / ``max`` / ``count`` with map-side partial
aggregation, the per-session lists of Q2 are assembled per (session, hour)
first and the hour pieces joined after, and the sample is a hash-ordered
bottom-k per hour found from a mergeable histogram; only the picked sessions
get their lists built.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import half_up, ordered_join, percent_half_up, tie_columns
from shoplens.params import Conditions
from shoplens.plans.joins import broadcast_rows, estimated_size

_TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _action_ts():
    """``action_time`` text as a zone-free timestamp.

    Aggregating the fixed-width timestamp instead of the text lets Spark use a
    hash aggregate with map-side combine (min / max of a string force a
    sort-based aggregate, i.e. a sort of the whole log).
    """
    return F.to_timestamp_ntz(F.col("action_time"), F.lit(_TS_FMT))


def _text(ts):
    return F.date_format(ts, _TS_FMT)


def _millis_between(start, end):
    return F.timestamp_diff("MILLISECOND", start, end)


def session_spans(actions: DataFrame, *keys: str) -> DataFrame:
    """Step count, first and last time per session (and keys, e.g. the day): mergeable by sum, min and max."""
    return actions.groupBy(*keys, "session_id").agg(
        F.count(F.lit(1)).alias("step_length"),
        F.min(_action_ts()).alias("t0"),
        F.max(_action_ts()).alias("t1"),
    )


def lengths_of(spans: DataFrame) -> DataFrame:
    return spans.select(
        "session_id", "step_length", _text(F.col("t0")).alias("start_time"),
        _millis_between(F.col("t0"), F.col("t1")).alias("visit_length"),
    )


def session_lengths(actions: DataFrame) -> DataFrame:
    """One row per session: step count, first action time, visit length in ms."""
    return lengths_of(session_spans(actions))


def session_stats(lengths: DataFrame, c: Conditions) -> DataFrame:
    """Session count and the four bucket shares (percent, one decimal, half up).

    Buckets: visit length <= / > ``c.visit_length_ms`` and steps <= / >
    ``c.step_length``, each ``<=`` inclusive.  Unlike the reference, the
    "steps >" bucket tests the step count (the reference tests the visit
    length there, ``> 5`` ms, so a session of more than five steps within
    5 ms, e.g. all in one second, fell in neither bucket).
    With no session every share is 0.0.
    """
    vl, st = F.col("visit_length"), F.col("step_length")
    n = F.count(F.lit(1))
    agg = lengths.agg(
        n.alias("session_count"),
        F.count_if(vl <= c.visit_length_ms).alias("vl_le"),
        F.count_if(vl > c.visit_length_ms).alias("vl_gt"),
        F.count_if(st <= c.step_length).alias("st_le"),
        F.count_if(st > c.step_length).alias("st_gt"),
    )
    total = F.col("session_count")
    return agg.select(
        "session_count",
        percent_half_up("vl_le", total).alias("visit_length_le_ratio"),
        percent_half_up("vl_gt", total).alias("visit_length_gt_ratio"),
        percent_half_up("st_le", total).alias("step_length_le_ratio"),
        percent_half_up("st_gt", total).alias("step_length_gt_ratio"),
    )


PROFILE_COLUMNS = ["session_id", "start_time", "step_length", "visit_length", "search_keywords",
                   "click_product_ids", "order_product_ids", "pay_product_ids"]

_LISTS = ["search_keywords", "click_product_ids", "order_product_ids", "pay_product_ids"]


def session_profile(actions: DataFrame) -> DataFrame:
    """SessionInfo per session: start, steps, length and four ordered lists.

    Lists hold, in action order (time, then tie key): search keywords, clicked
    product ids (clicks only, ``-1`` is no click), ordered and paid product id
    texts (kept whole, as the reference does).  A list with no entry is "".

    Two aggregation levels keep every buffer small: each (session, hour) joins
    its own rows (``listagg ... WITHIN GROUP``, partially aggregated map-side),
    then each session joins its hour pieces in hour order.  The finished lists
    are the output row itself, so only they are ever whole in one place (Spark
    limits a row to 2 GB).
    """
    ties = [f"`{t}`" for t in tie_columns(actions)]
    clicked = "CASE WHEN click_product_id <> -1 THEN CAST(click_product_id AS STRING) END"
    sources = {"search_keywords": "search_keyword", "click_product_ids": clicked,
               "order_product_ids": "order_product_ids", "pay_product_ids": "pay_product_ids"}
    hourly = actions.groupBy("session_id", F.substring("action_time", 1, 13).alias("hour")).agg(
        F.count(F.lit(1)).alias("steps"),
        # The list aggregate makes this a sort-based aggregate anyway, so the
        # text (whose order is time order) is compared directly.
        F.min("action_time").alias("first_time"),
        F.max("action_time").alias("last_time"),
        # Without a tie key the value itself orders entries of equal time.
        *[ordered_join(src, ["action_time", *(ties or [src])]).alias(name) for name, src in sources.items()],
    )
    per_session = hourly.groupBy("session_id").agg(
        F.sum("steps").alias("step_length"),
        F.min("first_time").alias("start_time"),
        F.max("last_time").alias("end_time"),
        *[ordered_join(name, ["hour"]).alias(name) for name in _LISTS],
    )
    parse = lambda c: F.to_timestamp_ntz(F.col(c), F.lit(_TS_FMT))
    return per_session.select(
        "session_id", "start_time", "step_length",
        _millis_between(parse("start_time"), parse("end_time")).alias("visit_length"),
        *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in _LISTS],
    )


def _day_hour(col="start_time"):
    return F.substring(col, 1, 13)


def session_starts(actions: DataFrame) -> DataFrame:
    """``session_id, start_time`` per session (one map-side combined pass)."""
    return (actions.groupBy("session_id").agg(F.min(_action_ts()).alias("t0"))
            .select("session_id", _text(F.col("t0")).alias("start_time")))


def hourly_quota(sessions: DataFrame, c: Conditions) -> DataFrame:
    """Sessions per start hour and the hour's share of ``c.sample_size``.

    ``sessions`` is any frame with ``start_time`` per session (the starts, the
    lengths or the profiles).  quota = floor(sessions / total * sample_size +
    0.5), capped at the hour's session count (the reference loops forever when
    the quota exceeds it).  The total is a scalar subquery, not a join.
    """
    hours = sessions.groupBy(_day_hour().alias("day_hour")).agg(F.count(F.lit(1)).alias("sessions"))
    total = hours.agg(F.sum("sessions")).scalar()
    share = F.try_divide(F.col("sessions").cast("double"), total.cast("double"))
    raw = half_up(share * F.lit(float(c.sample_size)))
    return hours.select("day_hour", "sessions",
                        F.least(F.coalesce(raw, F.lit(0)), F.col("sessions")).alias("quota"))


def bins_for(sessions: DataFrame, rows_per_bin: int = 10_000) -> int:
    """Bins of the hash histogram: by Catalyst's size estimate, 64 to 65536."""
    size = estimated_size(sessions) or 0
    return int(min(65536, max(64, size // (rows_per_bin * 64))))


def hours_between(c: Conditions) -> int | None:
    """Start hours there can be inside the conditions' days; None without both bounds."""
    if not (c.start_date and c.end_date):
        return None
    return max(0, (date.fromisoformat(c.end_date) - date.fromisoformat(c.start_date)).days + 1) * 24


def pick_sessions(sessions: DataFrame, quota: DataFrame, c: Conditions,
                  bins: int | None = None) -> DataFrame:
    """Ids of the ``quota`` sessions picked in each start hour, without repeats.

    The pick is the sessions with the smallest ``md5(session_id || '-' || seed)``
    (session id breaks ties): uniform like the reference's random pick, but
    exact in size and repeatable.

    The bottom of each hour is found from a mergeable histogram: sessions are
    counted by (hour, leading hash digits), combined in every task.  An hour's bins
    are added up until they hold its quota; only sessions up to that bin, the quota
    and what else the last bin holds, are gathered and cut to the quota.  A hot hour
    is spread over its bins (``bins``, by the input's size if not given).
    """
    count = bins_for(sessions) if bins is None else int(bins)
    h = F.md5(F.concat(F.col("session_id"), F.lit("-"), F.lit(c.sample_seed)))
    keys = sessions.select("session_id", _day_hour().alias("day_hour"), h.alias("h")).withColumn(
        "bin", F.floor(F.conv(F.substring("h", 1, 4), 16, 10).cast("bigint") * F.lit(count) / F.lit(65536)).cast("int"))
    histogram = keys.groupBy("day_hour", "bin").agg(F.count(F.lit(1)).alias("n"))
    hours = histogram.groupBy("day_hour").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("counts"))

    def add(acc, x):
        return F.when((acc["last"] >= 0) | (F.col("quota") <= 0), acc).otherwise(F.struct(
            (acc["upto"] + x["n"]).alias("upto"),
            F.when(acc["upto"] + x["n"] >= F.col("quota"), x["bin"]).otherwise(F.lit(-1)).alias("last")))

    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(-1).alias("last"))
    cuts = hours.join(quota.select(F.col("day_hour"), F.col("quota").cast("bigint").alias("quota")), "day_hour").select(
        "day_hour", "quota", F.aggregate("counts", start, add)["last"].alias("last"))
    most = hours_between(c)
    near = keys.join(cuts if most is None else broadcast_rows(cuts, most), "day_hour").where(F.col("bin") <= F.col("last"))
    bottom = near.groupBy("day_hour").agg(
        F.array_sort(F.collect_list(F.struct("h", "session_id"))).alias("low"), F.max("quota").cast("int").alias("quota"))
    return bottom.select(F.explode(F.slice("low", F.lit(1), F.col("quota"))).alias("x")).select("x.session_id")


def session_sample(profile: DataFrame, quota: DataFrame, c: Conditions,
                   bins: int | None = None) -> DataFrame:
    """The picked sessions' profiles, from already built profiles."""
    picked = pick_sessions(profile, quota, c, bins)
    return profile.join(picked, "session_id", "left_semi").select(*PROFILE_COLUMNS)


def sample_profiles(actions: DataFrame, c: Conditions, bins: int | None = None) -> DataFrame:
    """Q2 end to end: pick from session start times, then profile only the picks.

    The pick needs only each session's start, so the lists are built for the
    sampled sessions alone.  There are at most ``2 * sample_size`` picked ids (a
    share of half a session or more is rounded up to at most its double); they
    are broadcast if that many fit the limit, else the join shuffles.
    """
    starts = session_starts(actions)
    picked = pick_sessions(starts, hourly_quota(starts, c), c, bins)
    sampled = actions.join(broadcast_rows(picked, 2 * int(c.sample_size)), "session_id", "left_semi")
    return session_profile(sampled).select(*PROFILE_COLUMNS)
