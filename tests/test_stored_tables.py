"""The stored-table source gives the same results as the fixture adapter."""

import pytest
from helpers import SF001, rows

from shoplens.params import DEFAULT_CONDITIONS
from shoplens.plans.queries import QUERY_NAMES, ShopQueries
from shoplens.sinks import save_table, write_shop_tables
from shoplens.sources.tables import FixtureTables, StoredTables


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("shop"))
    fixture = FixtureTables(spark, SF001)
    write_shop_tables(fixture, base)
    return ShopQueries(fixture, DEFAULT_CONDITIONS), ShopQueries(StoredTables(spark, base), DEFAULT_CONDITIONS)


@pytest.mark.parametrize("name", [n for n in QUERY_NAMES if not n.startswith("q7_clean")])
def test_same_results(both, name):
    fx, st = both
    assert rows(getattr(st, name)()) == rows(getattr(fx, name)())


def test_clean_clicks_same_rows(both):
    fx, st = both
    cols = ["event_id", "area", "city", "user_id", "ads_id"]
    assert rows(st.q7_clean_clicks(), *cols) == rows(fx.q7_clean_clicks(), *cols)


def test_date_bounds_prune_partitions(both):
    _, st = both
    plan = st.q0_filtered_actions()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "(date#" in plan and ">= 2024-01-05" in plan and "<= 2024-01-25" in plan


def test_log_without_tie_key(spark, tmp_path):
    """The reference's log has no tie key: every job still runs, and the jobs
    whose results cannot depend on the order of same-second actions agree."""
    fixture = FixtureTables(spark, SF001)
    base = str(tmp_path / "shop")
    # The same layout as write_shop_tables, with the log's tie key left out.
    save_table(fixture.user_visit_action().drop("event_id"), f"{base}/user_visit_action",
               partition_by=["date"])
    for name in ("user_info", "city_info", "product_info"):
        save_table(getattr(fixture, name)(), f"{base}/{name}")
    st = ShopQueries(StoredTables(spark, base), DEFAULT_CONDITIONS)
    fx = ShopQueries(fixture, DEFAULT_CONDITIONS)
    assert "event_id" not in st.q0_filtered_actions().columns
    for name in ("q1_session_stats", "q1_session_lengths", "q2_hourly_quota", "q3_category_top10",
                 "q4_category_top_sessions", "q6_area_top3_products"):
        assert rows(getattr(st, name)()) == rows(getattr(fx, name)()), name
    for name in ("q2_session_profile", "q2_session_sample", "q5_page_conversion"):
        assert getattr(st, name)().count() == getattr(fx, name)().count(), name
