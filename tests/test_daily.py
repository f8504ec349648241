"""Daily partials: a range merged from days equals the range, days are replaced, sessions run past midnight."""

import pytest
from helpers import SF001, actions, rows
from pyspark.sql import functions as F

from shoplens.operators import areas, categories, daily, pages, sessions
from shoplens.params import DEFAULT_CONDITIONS as C
from shoplens.plans.queries import ShopQueries
from shoplens.sources.tables import FixtureTables


@pytest.fixture(scope="module")
def log(spark):
    """Filtered actions whose sessions run over many days."""
    acts = ShopQueries(FixtureTables(spark, SF001)).q0_filtered_actions()
    return acts.withColumn("session_id", (F.col("user_id") % 5).cast("string")).cache()


def _store(spark, path, log, cities, by_day):
    store = daily.DailyStore(spark, str(path))
    days = sorted(r.date for r in log.select("date").distinct().collect())
    cuts = [log.where(F.col("date") == d) for d in days] if by_day else [log]
    for part in cuts:
        store.add("sessions", daily.session_days(part))
        store.add("categories", daily.category_days(part))
        store.add("areas", daily.area_days(part, cities))
        store.add("pages", daily.page_days(part, C))
    return store, days


def _answers(store, lo=None, hi=None):
    return [rows(daily.lengths_from_days(store.read("sessions", lo, hi))), rows(daily.top_from_days(store.read("categories", lo, hi))),
            rows(daily.share_from_days(store.read("areas", lo, hi), C)), rows(daily.conversion_from_days(store.read("pages", lo, hi), C))]


def _plain(log, cities):
    return [rows(sessions.session_lengths(log)), rows(categories.category_top(log)), rows(areas.city_share(log, cities, C)),
            rows(pages.page_conversion(log, C))]


def test_days_added_one_by_one_equal_the_whole_log(spark, tmp_path, log):
    cities = FixtureTables(spark, SF001).city_info()
    few = log.where(F.col("date") <= "2024-01-09")
    one, days = _store(spark, tmp_path / "a", few, cities, by_day=True)
    assert len(days) == 5
    assert _answers(one) == _plain(few, cities)
    # a range reads its own days only
    lo, hi = days[1], days[3]
    assert _answers(one, lo, hi) == _plain(few.where(F.col("date").between(lo, hi)), cities)
    plan = one.read("sessions", lo, hi)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(date") == 1, plan
    # a day that is run again replaces itself, the others stay
    one.add("sessions", daily.session_days(few.where(F.col("date") == days[2])))
    assert _answers(one) == _plain(few, cities)


def test_a_session_past_midnight_is_one_session(spark):
    acts = actions(spark,
                   dict(session_id="s", page_id=1, action_time="2024-01-05 23:59:58"),
                   dict(session_id="s", page_id=2, action_time="2024-01-06 00:00:01"),
                   dict(session_id="s", page_id=3, action_time="2024-01-07 00:00:00"),
                   dict(session_id="t", page_id=1, action_time="2024-01-06 00:00:00"))
    got = {r.session_id: (r.step_length, r.start_time, r.visit_length) for r in daily.lengths_from_days(daily.session_days(acts)).collect()}
    assert got == {"s": (3, "2024-01-05 23:59:58", 86_402_000), "t": (1, "2024-01-06 00:00:00", 0)}
    assert rows(daily.conversion_from_days(daily.page_days(acts, C), C)) == [("1-2", 50.0), ("2-3", 100.0)]
    assert daily.page_days(acts, C).count() == 4
