"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per job.

Each builds the shop tables from the fixture parquet in ``sf_dir`` and runs
one job over the whole tables under the default conditions.  Building a query
runs no Spark job (the caller's action does), except for the jobs on clean
clicks, which first find the (user, ad, day) groups that reach the limit, and
the stream queries, which run the stream to its end and return its tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import api
from shoplens.operators import ads, categories, daily, pages, sessions
from shoplens.operators.actions import filter_actions
from shoplens.params import DEFAULT_CONDITIONS, Conditions
from shoplens.plans.odd_lines import odd_ad_lines
from shoplens.plans.replay import clean_lines, replayed
from shoplens.sources.adlog import parse_ad_lines
from shoplens.sources.tables import FixtureTables, ShopTables


def filtered_actions(t: ShopTables, c: Conditions) -> DataFrame:
    """Q0 with the date bounds also handed to the source for scan pruning."""
    return filter_actions(t.user_visit_action(c.start_date, c.end_date), t.user_info(), c)


class ShopQueries:
    """The jobs over one table source and one set of conditions."""

    def __init__(self, tables: ShopTables, c: Conditions = DEFAULT_CONDITIONS):
        self.t, self.c = tables, c

    # batch jobs on the action log
    def q0_filtered_actions(self):
        return filtered_actions(self.t, self.c)

    def q1_session_lengths(self):
        return sessions.session_lengths(self.q0_filtered_actions())

    def q1_session_stats(self):
        return api.session_stats(self.q0_filtered_actions(), self.c)

    def q2_session_profile(self):
        return sessions.session_profile(self.q0_filtered_actions())

    def q2_hourly_quota(self):
        return sessions.hourly_quota(sessions.session_starts(self.q0_filtered_actions()), self.c)

    def q2_session_sample(self):
        return api.sample_profiles(self.q0_filtered_actions(), self.c)

    def q3_category_top10(self):
        return categories.category_top(self.q0_filtered_actions(), self.c.top_categories)

    def q4_category_top_sessions(self):
        acts = self.q0_filtered_actions()
        top = categories.category_top(acts, self.c.top_categories)
        return categories.category_top_sessions(acts, top, self.c.top_sessions)

    def q4_top_sessions_one_scan(self):
        return categories.top_category_sessions(self.q0_filtered_actions(), self.c.top_categories, self.c.top_sessions)

    # The same jobs merged from daily partials.  Sessions are the users' here, so that they run past midnight.
    def _user_sessions(self):
        return self.q0_filtered_actions().withColumn("session_id", F.col("user_id").cast("string"))

    def q1_lengths_from_days(self):
        return daily.lengths_from_days(daily.session_days(self._user_sessions()))

    def q3_top10_from_days(self):
        return daily.top_from_days(daily.category_days(self.q0_filtered_actions()), self.c.top_categories)

    def q5_conversion_from_days(self):
        return daily.conversion_from_days(daily.page_days(self._user_sessions(), self.c), self.c)

    def q6_share_from_days(self):
        days = daily.area_days(self.t.user_visit_action(), self.t.city_info())
        return daily.share_from_days(days, self.c).select("area", "product_id", "remark")

    def q5_page_conversion(self):
        hot = pages.hot_sessions(self.t.user_visit_action(self.c.start_date, self.c.end_date))
        return pages.page_conversion(self.q0_filtered_actions(), self.c, hot=hot)

    def q5_page_pairs(self):
        # Hour pieces: many more pairs lie inside a piece than with minutes.
        return pages.page_pairs(self.q0_filtered_actions(), "hour")

    # Q6 reads the whole log, without the Q0 conditions (as the reference does)
    def q6_city_share(self):
        return api.city_share(self.t.user_visit_action(), self.t.city_info(), self.c).select("area", "product_id", "remark")

    def q6_area_top3_products(self):
        return api.area_top_products(self.t.user_visit_action(), self.t.city_info(), self.t.product_info(), self.c)

    # ad-click jobs, batch form of the stream
    def q_ad_lines_parsed(self):
        parsed = parse_ad_lines(odd_ad_lines(self.t.ads_click()))
        return parsed.select("event_id", "value", F.when(F.col("is_valid"), F.unix_millis("ts")).alias("ts_ms"), "area", "city", "user_id", "ads_id", "reason")

    def q7_blacklist(self):
        return ads.blacklist(self.t.ads_click(), self.c.blacklist_limit)

    def q7_clean_clicks(self):
        return ads.clean_clicks(self.t.ads_click(), self.c.blacklist_limit)

    def q7_unbanned_clicks(self):
        # The form for a list too long to broadcast, whatever its size here.
        clicks = self.t.ads_click()
        return ads.drop_blacklisted(clicks, ads.blacklist(clicks, self.c.blacklist_limit), max_bytes=-1)

    def q8_ads_per_day(self):
        return ads.ads_per_day(self.q7_clean_clicks())

    def q9_area_top3_ads(self):
        return ads.area_top_ads(self.q8_ads_per_day(), self.c.top_ads)

    def q9_area_top3_ads_json(self):
        return ads.area_top_ads_json(self.q9_area_top3_ads())

    def q10_minute_counts(self):
        per = ads.minute_counts(self.q7_clean_clicks())
        return per.select("ads_id", F.date_format("m", "yyyy-MM-dd HH:mm").alias("minute"), "n")

    def q10_last_hour(self):
        return ads.last_hour_trend(self.q7_clean_clicks(), self.c.window_minutes)

    def q10_sliding_hour(self):
        return ads.sliding_hour(self.q7_clean_clicks(), self.c.window_minutes, self.c.slide_seconds)

    def q10_last_hour_json(self):
        return ads.last_hour_json(self.q7_clean_clicks(), self.c.window_minutes)


    # the stream jobs themselves, run over the clicks when the query is built
    def _stream(self):
        return replayed(self.t.spark, self.t, self.c)

    def q7_stream_blacklist(self):
        return self._stream().blacklist_batch()

    def q7_stream_clean_clicks(self):
        return clean_lines(self._stream())

    def q8_stream_ads_per_day(self):
        return self._stream().latest("ads_per_day")

    def q9_stream_top3_ads(self):
        return self._stream().latest("area_top_ads")

    def q10_stream_last_hour(self):
        return self._stream().last_hour_trend()


QUERY_NAMES = [
    "q0_filtered_actions", "q1_session_lengths", "q1_session_stats",
    "q2_session_profile", "q2_hourly_quota", "q2_session_sample",
    "q3_category_top10", "q4_category_top_sessions", "q5_page_conversion", "q5_page_pairs",
    "q6_area_top3_products", "q6_city_share",
    "q4_top_sessions_one_scan", "q1_lengths_from_days", "q3_top10_from_days", "q5_conversion_from_days", "q6_share_from_days",
    "q_ad_lines_parsed", "q7_blacklist", "q7_clean_clicks", "q7_unbanned_clicks", "q8_ads_per_day",
    "q9_area_top3_ads", "q9_area_top3_ads_json", "q10_minute_counts", "q10_last_hour", "q10_last_hour_json", "q10_sliding_hour",
    "q7_stream_blacklist", "q7_stream_clean_clicks", "q8_stream_ads_per_day", "q9_stream_top3_ads", "q10_stream_last_hour",
]


def _runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str, c: Conditions = DEFAULT_CONDITIONS) -> DataFrame:
        return getattr(ShopQueries(FixtureTables(spark, sf_dir), c), name)()
    run.__name__ = name
    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(name) for name in QUERY_NAMES}
