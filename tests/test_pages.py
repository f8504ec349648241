from collections import Counter

import pytest
from helpers import SF001, actions, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoplens.operators import pages
from shoplens.params import Conditions
from shoplens.plans.queries import ShopQueries
from shoplens.sources.tables import FixtureTables


def _brute_pairs(pdf):
    """Adjacent page pairs per session after a full sort (the plain definition)."""
    out = Counter()
    for _, g in pdf.sort_values(["session_id", "action_time", "event_id"]).groupby("session_id"):
        p = list(g.page_id)
        out.update(zip(p, p[1:]))
    return out


def test_ties_in_one_second_follow_tie_key(spark):
    acts = actions(spark,
                   dict(page_id=2, action_time="2024-01-05 10:00:00", event_id=2),
                   dict(page_id=1, action_time="2024-01-05 10:00:00", event_id=1),
                   dict(page_id=3, action_time="2024-01-05 10:00:01", event_id=0))
    assert rows(pages.page_steps(acts)) == [(1, 2), (2, 3)]


def test_flow_edge_cases(spark):
    acts = actions(spark,
                   dict(page_id=1, action_time="2024-01-05 10:00:00"),
                   dict(page_id=2, action_time="2024-01-05 10:00:01"),
                   dict(page_id=1, action_time="2024-01-05 10:00:02"),
                   dict(page_id=2, action_time="2024-01-05 10:00:03"))
    # one page: no pairs
    assert pages.page_conversion(acts, Conditions(page_flow=(1,))).count() == 0
    # repeated pages: pairs as a set; 1 visited twice, jumped 1->2 twice
    got = rows(pages.page_conversion(acts, Conditions(page_flow=(1, 2, 1, 2))))
    assert got == [("1-2", 100.0), ("2-1", 50.0)]
    with pytest.raises(ValueError):
        pages.page_conversion(acts, Conditions(page_flow=None))


def test_include_zero_reports_missing_jumps(spark):
    acts = actions(spark, dict(page_id=1), dict(page_id=3, action_time="2024-01-05 10:00:01"))
    got = rows(pages.page_conversion(acts, Conditions(page_flow=(1, 2, 3)), include_zero=True))
    assert got == [("1-2", 0.0), ("2-3", 0.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 4 * 3600), st.integers(1, 4)),
                min_size=1, max_size=40))
def test_hour_split_lead_equals_whole_session_sort(spark, events):
    specs = [dict(session_id=f"s{s}", page_id=p,
                  action_time=f"2024-01-05 {10 + t // 3600:02d}:{t % 3600 // 60:02d}:{t % 60:02d}")
             for s, t, p in events]
    df = actions(spark, *specs)
    brute = _brute_pairs(df.toPandas())
    for split in ("hour", "minute"):
        got = Counter(pages.page_steps(df, split).toPandas().itertuples(index=False, name=None))
        assert got == brute


def test_fixture_pairs_equal_brute_force(spark):
    acts = ShopQueries(FixtureTables(spark, SF001)).q0_filtered_actions()
    got = Counter(pages.page_steps(acts).toPandas().itertuples(index=False, name=None))
    assert got == _brute_pairs(acts.toPandas())


def test_hour_pieces_hold_pairs_inside(spark):
    """The registered pair counts cover pairs inside a piece, not only across pieces."""
    from pyspark.sql import functions as F

    acts = ShopQueries(FixtureTables(spark, SF001)).q0_filtered_actions()
    seq = pages._sequence(acts, "hour")
    inner, all_ = seq.where(~F.col("is_last")).count(), pages.page_steps(acts, "hour").count()
    assert 0 < inner < all_
    assert sum(r.n for r in pages.page_pairs(acts, "hour").collect()) == all_


def test_conversion_sorts_the_log_once(spark):
    from shoplens.params import DEFAULT_CONDITIONS

    df = pages.page_conversion(ShopQueries(FixtureTables(spark, SF001)).q0_filtered_actions(), DEFAULT_CONDITIONS)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("lead(pre_page") + plan.count("lead(page_id") >= 1
    # The window over the log is planned once; other uses of its aggregate are reused exchanges.
    assert plan.count("row_number()") == 1, plan


def test_segments_merge_in_any_grouping(spark):
    """Minute segments merged by hour, by day or not at all give the rates of the whole sessions."""
    from pyspark.sql import functions as F

    from shoplens.params import DEFAULT_CONDITIONS as c

    acts = ShopQueries(FixtureTables(spark, SF001)).q0_filtered_actions()
    acts = acts.withColumn("session_id", (F.col("user_id") % 3).cast("string"))      # sessions over many days
    pairs = pages.flow_pairs(c)
    brute = _brute_pairs(acts.select("session_id", "action_time", "event_id", "page_id").toPandas())
    visits = Counter(r.page_id for r in acts.select("page_id").collect())
    expect = sorted((f"{a}-{b}", int(brute[a, b] / visits[a] * 1000 + 0.5) / 10) for a, b in pairs if brute[a, b])
    fine = pages.page_segments(acts, pairs, "minute")
    hour = pages.merge_segments(fine, pairs, F.substring("piece", 1, 13))
    day = pages.merge_segments(hour, pairs, F.substring("piece", 1, 10))
    whole = pages.merge_segments(day, pairs, F.lit(""))
    counts = [x.count() for x in (fine, hour, day, whole)]
    assert counts == sorted(counts, reverse=True) and counts[-1] == 3
    for segs in (fine, hour, day, whole):
        assert rows(pages.conversion_from_segments(segs, pairs)) == expect


def test_only_hot_sessions_are_cut(spark):
    from pyspark.sql import functions as F

    from shoplens.params import DEFAULT_CONDITIONS as c

    acts = ShopQueries(FixtureTables(spark, SF001)).q0_filtered_actions()
    acts = acts.withColumn("session_id", F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.col("session_id")))
    hot = pages.hot_sessions(acts, rows=50, most=5)
    pairs = pages.flow_pairs(c)
    segs = pages.page_segments(acts, pairs, hot=hot)
    cut = {r.session_id: r.n for r in segs.groupBy("session_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert cut.pop("hot") > 50 and set(cut.values()) == {1}
    assert rows(pages.page_conversion(acts, c, hot=hot)) == rows(pages.page_conversion(acts, c)) == rows(pages.page_conversion(acts, c, split="hour"))


def test_conversion_exchanges_the_log_once(spark):
    from shoplens.params import DEFAULT_CONDITIONS

    df = ShopQueries(FixtureTables(spark, SF001)).q5_page_conversion()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 2 and "ReusedExchange" not in plan     # log rows, then one row a session
    assert "Join" not in plan.replace("BroadcastHashJoin", "")
    assert pages.page_conversion(ShopQueries(FixtureTables(spark, SF001)).q0_filtered_actions().limit(0), DEFAULT_CONDITIONS).count() == 0
