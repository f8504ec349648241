from helpers import SF01, actions, rows
from pyspark.sql import functions as F

from shoplens.operators import categories
from shoplens.plans.queries import ShopQueries
from shoplens.sources.tables import FixtureTables


def test_first_matching_kind_only(spark):
    # click and order on one row -> click only
    acts = actions(spark, dict(click_category_id=3, order_category_ids="4"))
    assert rows(categories.category_counts(acts)) == [("3", 1, 0, 0)]


def test_list_texts_and_repeats(spark):
    acts = actions(spark,
                   dict(order_category_ids="1,,2,,"),
                   dict(order_category_ids=",,"),
                   dict(order_category_ids=""),
                   dict(pay_category_ids="5,5"),
                   dict(pay_category_ids=None))
    assert rows(categories.category_counts(acts)) == [
        ("", 0, 2, 0),
        ("1", 0, 1, 0), ("2", 0, 1, 0), ("5", 0, 0, 2)]


def test_top_order_is_total(spark):
    acts = actions(spark,
                   *[dict(click_category_id=1) for _ in range(2)],
                   *[dict(click_category_id=2) for _ in range(2)],
                   dict(order_category_ids="2"),
                   *[dict(click_category_id=3) for _ in range(2)],
                   dict(order_category_ids="3"), dict(pay_category_ids="3"),
                   dict(click_category_id=4))
    top = categories.category_top(acts, 3)
    assert [r.category_id for r in top.collect()] == ["3", "2", "1"]


def test_top_sessions_limit_and_ties(spark):
    specs = []
    for i in range(12):
        specs += [dict(click_category_id=7, session_id=f"s{i:02d}")] * (1 + (i % 3))
    specs += [dict(click_category_id=8, session_id="x")]
    acts = actions(spark, *specs)
    top = categories.category_top(acts, 1)
    got = rows(categories.category_top_sessions(acts, top, 10))
    assert len(got) == 10 and {r[0] for r in got} == {"7"}
    # four sessions with 3 clicks, four with 2, then the two smallest ids of
    # the four sessions with 1 click
    by = sorted(got, key=lambda r: (-r[2], r[1]))
    assert [r[1] for r in by[:4]] == ["s02", "s05", "s08", "s11"]
    assert [r[1] for r in by[8:]] == ["s00", "s03"]


def test_totals_equal_exploded_events(spark):
    q = ShopQueries(FixtureTables(spark, SF01))
    acts = q.q0_filtered_actions()
    counts = categories.category_counts(acts)
    tot = counts.agg(F.sum("click_count"), F.sum("order_count"), F.sum("pay_count")).collect()[0]
    ev = categories.category_events(acts)
    assert tuple(tot) == tuple(ev.where(F.col("kind") == k).count() for k in ("click", "order", "pay"))


def test_top_sessions_in_one_scan(spark):
    from shoplens.plans.queries import ShopQueries
    from shoplens.sources.tables import FixtureTables

    q = ShopQueries(FixtureTables(spark, SF01))
    for acts in (q.q0_filtered_actions(), q.q0_filtered_actions().withColumn("session_id", F.lit("hot")),
                 q.q0_filtered_actions().withColumn("session_id", F.when(F.col("user_id") % 2 == 0, F.col("session_id")))):
        for n, k in ((10, 10), (2, 1), (30, 3)):
            expect = categories.category_top_sessions(acts, categories.category_top(acts, n), k)
            df = categories.top_category_sessions(acts, n, k)
            assert rows_with_nulls(df) == rows_with_nulls(expect)
    df = categories.top_category_sessions(q.q0_filtered_actions())
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the log once, its users once; everything else is read from one exchange
    assert plan.count("FileScan") <= 2 and "ReusedExchange" in plan, plan


def rows_with_nulls(df):
    return sorted(((r.category_id, r.session_id or "", r.session_id is None, r.click_count) for r in df.collect()))
