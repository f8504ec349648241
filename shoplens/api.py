"""Public API: one DataFrame -> DataFrame function per job.

Every function is lazy (builds a plan, runs no job; ``clean_clicks`` first counts
the groups that reach the limit) and works on any source of the shop tables.  The shapes follow the job list of the reference:

    Q0  filter_actions(actions, users, c)
    Q1  session_stats(actions, c), session_lengths(actions)
    Q2  session_profile(actions), hourly_quota(profile, c), session_sample(profile, c),
        sample_profiles(actions, c)
    Q3  category_top(actions, k)
    Q4  category_top_sessions(actions, top, k)
    Q5  page_conversion(actions, c)
    Q6  area_top_products(actions, cities, products, c), city_share(actions, cities, c)
    Q7  blacklist(clicks, limit), clean_clicks(clicks, limit), drop_blacklisted(clicks, users)
    Q8  ads_per_day(clicks)
    Q9  area_top_ads(per_day, k), area_top_ads_json(top)
    Q10 last_hour_trend(clicks, minutes), last_hour_json(clicks, minutes),
        sliding_hour(clicks, minutes, seconds)
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplens.operators import areas as _areas
from shoplens.operators import sessions as _sessions
from shoplens.operators.actions import filter_actions  # noqa: F401
from shoplens.operators.ads import (  # noqa: F401
    ads_per_day,
    area_top_ads,
    area_top_ads_json,
    blacklist,
    clean_clicks,
    drop_blacklisted,
    last_hour_json,
    last_hour_trend,
    sliding_hour,
)
from shoplens.operators.categories import category_top, category_top_sessions, top_category_sessions  # noqa: F401
from shoplens.operators.pages import page_conversion  # noqa: F401
from shoplens.operators.sessions import hourly_quota, session_lengths, session_profile  # noqa: F401
from shoplens.params import Conditions


def session_stats(actions: DataFrame, c: Conditions) -> DataFrame:
    """Q1 from the action log: session count and the four bucket shares."""
    return _sessions.session_stats(_sessions.session_lengths(actions), c)


def session_sample(profile: DataFrame, c: Conditions, bins: int | None = None) -> DataFrame:
    """Q2 sample from the session profiles, with the hourly quotas computed here."""
    return _sessions.session_sample(profile, _sessions.hourly_quota(profile, c), c, bins)


def sample_profiles(actions: DataFrame, c: Conditions, bins: int | None = None) -> DataFrame:
    """Q2 sample from the action log; lists are built for the picked sessions only."""
    return _sessions.sample_profiles(actions, c, bins)


def city_share(actions: DataFrame, cities: DataFrame, c: Conditions) -> DataFrame:
    return _areas.city_share(actions, cities, c)


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame,
                      c: Conditions) -> DataFrame:
    """Q6: ``area, product_name, cnt, rk, remark`` for the top clicked products per area."""
    return _areas.area_top_products(_areas.city_share(actions, cities, c), products, c.top_products)
