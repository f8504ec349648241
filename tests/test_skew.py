"""Hot keys: one session, one hour or one user holding every row.

The fixture is rewritten so that a single key carries the whole table, and
each operator that splits or salts hot groups is checked against a plain
brute force in pandas.
"""

from collections import Counter

import pytest
from helpers import SF01, rows
from pyspark.sql import functions as F

from shoplens.operators import ads, pages, sessions
from shoplens.params import DEFAULT_CONDITIONS
from shoplens.plans.queries import ShopQueries
from shoplens.sources.tables import FixtureTables


@pytest.fixture(scope="module")
def hot_session(spark):
    acts = ShopQueries(FixtureTables(spark, SF01)).q0_filtered_actions()
    return acts.withColumn("session_id", F.lit("hot"))


def test_page_steps_of_one_hot_session(spark, hot_session):
    pdf = hot_session.select("action_time", "event_id", "page_id").toPandas()
    p = list(pdf.sort_values(["action_time", "event_id"]).page_id)
    expect = Counter(zip(p, p[1:]))
    got = Counter(pages.page_steps(hot_session).toPandas().itertuples(index=False, name=None))
    assert got == expect and sum(got.values()) == len(p) - 1


def test_profile_of_one_hot_session(spark, hot_session):
    pdf = hot_session.toPandas().sort_values(["action_time", "event_id"])
    prof = sessions.session_profile(hot_session).collect()
    assert len(prof) == 1
    r = prof[0]
    assert r.step_length == len(pdf)
    assert r.search_keywords == ",".join(pdf.search_keyword.dropna())
    assert r.order_product_ids == ",".join(pdf.order_product_ids.dropna())
    clicks = pdf.click_product_id[pdf.click_product_id != -1].astype(str)
    assert r.click_product_ids == ",".join(clicks)


def test_sample_of_one_hot_hour(spark):
    prof = ShopQueries(FixtureTables(spark, SF01)).q2_session_profile()
    one_hour = prof.withColumn("start_time", F.lit("2024-01-05 10:00:00"))
    c = DEFAULT_CONDITIONS
    quota = sessions.hourly_quota(one_hour, c)
    assert rows(quota, "sessions", "quota") == [(prof.count(), c.sample_size)]
    salted = rows(sessions.pick_sessions(one_hour, quota, c, bins=64))
    plain = one_hour.select("session_id", F.md5(F.concat("session_id", F.lit("-"), F.lit(c.sample_seed))).alias("h"))
    expect = sorted((r.session_id,) for r in plain.orderBy("h", "session_id").limit(c.sample_size).collect())
    assert salted == expect


def test_clean_clicks_of_one_hot_user(spark):
    clicks = FixtureTables(spark, SF01).ads_click().withColumn("user_id", F.lit("1"))
    limit = 40
    pdf = clicks.toPandas().sort_values(["ts", "event_id"]).reset_index(drop=True)
    pdf["day"] = pdf.ts.dt.strftime("%Y-%m-%d")
    pdf["nth"] = pdf.groupby(["ads_id", "day"]).cumcount() + 1
    hit = pdf.index[pdf.nth == limit]
    expect = set(pdf.event_id[: hit.min() + 1]) if len(hit) else set(pdf.event_id)
    got = {r.event_id for r in ads.clean_clicks(clicks, limit).select("event_id").collect()}
    assert got == expect and len(hit) > 0
