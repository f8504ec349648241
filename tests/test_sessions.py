import pytest
from helpers import SF01, actions, rows, users
from pyspark.sql import functions as F

from shoplens.operators import sessions
from shoplens.operators.actions import filter_actions
from shoplens.params import DEFAULT_CONDITIONS, Conditions
from shoplens.plans.queries import ShopQueries
from shoplens.sources.tables import FixtureTables


def _t(sec):
    return f"2024-01-05 10:{sec // 60:02d}:{sec % 60:02d}"


def test_filter_actions_bounds_and_unknown_users(spark):
    acts = actions(spark,
                   dict(user_id=1, action_time="2024-01-04 23:59:59"),
                   dict(user_id=1, action_time="2024-01-05 00:00:00"),
                   dict(user_id=2, action_time="2024-01-06 00:00:00"),
                   dict(user_id=3, action_time="2024-01-06 00:00:00"),   # too old
                   dict(user_id=9, action_time="2024-01-06 00:00:00"))   # unknown user
    us = users(spark, (1, 15), (2, 55), (3, 56))
    c = Conditions(start_date="2024-01-05", end_date="2024-01-06", start_age=15, end_age=55)
    got = rows(filter_actions(acts, us, c), "event_id")
    assert got == [(1,), (2,)]
    # empty strings mean "no bound"
    c2 = Conditions(start_date="", end_date="", start_age="", end_age="")
    assert len(rows(filter_actions(acts, us, c2), "event_id")) == 4


def test_bucket_edges_inclusive(spark):
    specs = []
    # s10000: exactly 10,000 ms; s10001: 11 s (second resolution) -> gt
    specs += [dict(session_id="a", action_time=_t(0)), dict(session_id="a", action_time=_t(10))]
    specs += [dict(session_id="b", action_time=_t(0)), dict(session_id="b", action_time=_t(11))]
    # 5 and 6 steps
    specs += [dict(session_id="c", action_time=_t(i)) for i in range(5)]
    specs += [dict(session_id="d", action_time=_t(i)) for i in range(6)]
    # 6 steps in one second: counts as step > 5 (the reference lost it)
    specs += [dict(session_id="e", action_time=_t(0)) for _ in range(6)]
    lengths = sessions.session_lengths(actions(spark, *specs))
    got = {r.session_id: (r.step_length, r.visit_length) for r in lengths.collect()}
    assert got == {"a": (2, 10000), "b": (2, 11000), "c": (5, 4000), "d": (6, 5000), "e": (6, 0)}
    st = sessions.session_stats(lengths, DEFAULT_CONDITIONS).collect()[0]
    assert st.session_count == 5
    assert (st.visit_length_le_ratio, st.visit_length_gt_ratio) == (80.0, 20.0)
    assert (st.step_length_le_ratio, st.step_length_gt_ratio) == (60.0, 40.0)


def test_no_sessions_gives_zero_ratios(spark):
    empty = actions(spark, dict()).where(F.lit(False))
    st = sessions.session_stats(sessions.session_lengths(empty), DEFAULT_CONDITIONS).collect()[0]
    assert st.session_count == 0
    assert [st[i] for i in range(1, 5)] == [0.0, 0.0, 0.0, 0.0]


def test_profile_lists_in_time_order_across_hours(spark):
    acts = actions(spark,
                   dict(session_id="s", action_time="2024-01-05 11:00:00", search_keyword="k3"),
                   dict(session_id="s", action_time="2024-01-05 09:59:59", search_keyword="k1",
                        event_id=50),
                   dict(session_id="s", action_time="2024-01-05 09:59:59", click_product_id=7,
                        click_category_id=2, event_id=40),
                   dict(session_id="s", action_time="2024-01-05 10:30:00", order_product_ids="1,2"),
                   dict(session_id="s", action_time="2024-01-05 10:31:00", pay_product_ids="2"),
                   dict(session_id="s", action_time="2024-01-05 10:32:00", search_keyword="k2"),
                   dict(session_id="t", action_time="2024-01-05 10:00:00"))
    got = {r.session_id: r for r in sessions.session_profile(acts).collect()}
    s = got["s"]
    assert s.start_time == "2024-01-05 09:59:59" and s.step_length == 6
    assert s.visit_length == 3601000
    assert s.search_keywords == "k1,k2,k3"
    assert (s.click_product_ids, s.order_product_ids, s.pay_product_ids) == ("7", "1,2", "2")
    t = got["t"]
    assert (t.search_keywords, t.click_product_ids, t.order_product_ids, t.pay_product_ids) == ("", "", "", "")


def test_quota_capped_when_few_sessions(spark):
    # 10 sessions in all: quota would be 100 per hour; it is capped, no endless loop
    acts = actions(spark, *[dict(session_id=f"s{i}", action_time=f"2024-01-05 1{i % 2}:00:00")
                            for i in range(10)])
    prof = sessions.session_profile(acts)
    q = sessions.hourly_quota(prof, DEFAULT_CONDITIONS)
    assert rows(q) == [("2024-01-05 10", 5, 5), ("2024-01-05 11", 5, 5)]
    sample = sessions.session_sample(prof, q, DEFAULT_CONDITIONS)
    assert sorted(r.session_id for r in sample.collect()) == sorted(f"s{i}" for i in range(10))


@pytest.fixture(scope="module")
def sf01_profile(spark):
    return ShopQueries(FixtureTables(spark, SF01)).q2_session_profile()


def test_sample_property_per_hour_size_and_no_repeats(spark, sf01_profile):
    q = sessions.hourly_quota(sf01_profile, DEFAULT_CONDITIONS)
    sample = sessions.session_sample(sf01_profile, q, DEFAULT_CONDITIONS)
    picked = sample.select("session_id", F.substring("start_time", 1, 13).alias("day_hour"))
    per_hour = dict(rows(picked.groupBy("day_hour").count()))
    for day_hour, sessions_n, quota in rows(q):
        assert per_hour.get(day_hour, 0) == min(quota, sessions_n)
    assert picked.count() == picked.select("session_id").distinct().count()


def test_sample_does_not_depend_on_the_bins(spark, sf01_profile):
    c = DEFAULT_CONDITIONS.with_(sample_size=3000)
    q = sessions.hourly_quota(sf01_profile, c)
    one = rows(sessions.session_sample(sf01_profile, q, c, bins=1), "session_id")
    many = rows(sessions.session_sample(sf01_profile, q, c, bins=64), "session_id")
    assert one == many and len(one) > 1000


def test_stats_shares_add_up(spark):
    st = ShopQueries(FixtureTables(spark, SF01)).q1_session_stats().collect()[0]
    assert abs(st.visit_length_le_ratio + st.visit_length_gt_ratio - 100) <= 0.1
    assert abs(st.step_length_le_ratio + st.step_length_gt_ratio - 100) <= 0.1


def test_sample_has_no_window_and_sends_few_rows_on(spark):
    df = ShopQueries(FixtureTables(spark, SF01)).q2_session_sample()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_sample_of_hours_without_a_quota(spark):
    sess = spark.createDataFrame([(f"s{i}", f"2024-01-05 {10 + (i > 0):02d}:00:00") for i in range(3000)], "session_id string, start_time string")
    c = Conditions(sample_size=100)
    q = sessions.hourly_quota(sess, c)
    assert rows(q, "sessions", "quota") == [(1, 0), (2999, 100)]
    got = rows(sessions.pick_sessions(sess, q, c))
    expect = sess.where("session_id <> 's0'").select("session_id", F.md5(F.concat("session_id", F.lit("-"), F.lit(c.sample_seed))).alias("h"))
    assert got == sorted((r.session_id,) for r in expect.orderBy("h", "session_id").limit(100).collect())
    assert sessions.pick_sessions(sess.limit(0), sessions.hourly_quota(sess.limit(0), c), c).count() == 0
