from helpers import clicks, rows
from pyspark.sql import functions as F

from shoplens.operators import ads


def test_blacklist_limit_is_per_user_ad_day(spark):
    cl = clicks(spark,
                ("2024-01-05 10:00:00", 1, 1), ("2024-01-05 10:01:00", 1, 1), ("2024-01-05 10:02:00", 1, 1),
                ("2024-01-05 10:00:00", 2, 1), ("2024-01-05 10:01:00", 2, 2), ("2024-01-05 10:02:00", 2, 3),
                ("2024-01-05 23:59:00", 3, 1), ("2024-01-06 00:00:00", 3, 1), ("2024-01-06 00:01:00", 3, 1))
    assert rows(ads.blacklist(cl, 3)) == [("1",)]
    assert rows(ads.blacklist(cl, 2)) == [("1",), ("3",)]


def test_clean_clicks_drop_only_after_the_limit_click(spark):
    cl = clicks(spark,
                ("2024-01-05 10:00:00", 1, 1), ("2024-01-05 10:01:00", 1, 1),
                ("2024-01-05 10:02:00", 1, 2),          # other ad, before the limit: kept
                ("2024-01-05 10:03:00", 1, 1),          # third click on ad 1: reaches the limit, kept
                ("2024-01-05 10:04:00", 1, 2),          # after: dropped (any ad)
                ("2024-01-07 09:00:00", 1, 5),          # after, another day: dropped
                ("2024-01-05 10:05:00", 2, 1))
    assert [r[0] for r in rows(ads.clean_clicks(cl, 3), "event_id")] == [0, 1, 2, 3, 6]


def test_last_hour_window_on_whole_minutes(spark):
    cl = clicks(spark,
                ("2024-01-05 12:30:59", 1, 1),   # latest minute 12:30
                ("2024-01-05 11:31:00", 2, 1),   # 59 minutes before: in
                ("2024-01-05 11:30:59", 3, 1),   # minute 60 before: out
                ("2024-01-05 12:30:01", 4, 2))
    got = rows(ads.last_hour_trend(cl, 60))
    assert got == [("1", "2024-01-05 11:31", 1), ("1", "2024-01-05 12:30", 1), ("2", "2024-01-05 12:30", 1)]
    js = dict(rows(ads.last_hour_json(cl, 60)))
    assert js == {"1": '[{"11:31":1},{"12:30":1}]', "2": '[{"12:30":1}]'}


def test_area_top_ads_ties_and_json(spark):
    cl = clicks(spark,
                *[("2024-01-05 10:00:00", 1, 4, "A", "c1")] * 2,
                *[("2024-01-05 10:00:00", 1, 4, "A", "c2")] * 1,
                *[("2024-01-05 10:00:00", 1, 2, "A", "c1")] * 3,
                *[("2024-01-05 10:00:00", 1, 3, "A", "c1")] * 3,
                *[("2024-01-05 10:00:00", 1, 1, "A", "c1")] * 1)
    per_day = ads.ads_per_day(cl)
    top = ads.area_top_ads(per_day, 3)
    assert rows(top, "ads_id", "n", "rn") == [("2", 3, 1), ("3", 3, 2), ("4", 3, 3)]
    js = ads.area_top_ads_json(top).collect()[0]
    assert js.ads_json == '[{"2":3},{"3":3},{"4":3}]'


def test_top_ads_are_a_subset_of_the_rollup(spark):
    from helpers import SF01
    from pyspark.sql import functions as F

    from shoplens.plans.queries import ShopQueries
    from shoplens.sources.tables import FixtureTables

    q = ShopQueries(FixtureTables(spark, SF01))
    per_day = q.q8_ads_per_day()
    rollup = per_day.groupBy("day", "area", "ads_id").agg(F.sum("n").alias("n"))
    top = q.q9_area_top3_ads()
    assert top.join(rollup, ["day", "area", "ads_id", "n"], "left_anti").count() == 0
    sizes = dict(((r.day, r.area), r.k) for r in rollup.groupBy("day", "area").agg(F.count("*").alias("k")).collect())
    got = dict(((r.day, r.area), r.k) for r in top.groupBy("day", "area").agg(F.count("*").alias("k")).collect())
    assert got == {key: min(3, k) for key, k in sizes.items()}


def test_drop_blacklisted_uses_the_given_list(spark):
    cl = clicks(spark, ("2024-01-05 10:00:00", 1, 1), ("2024-01-05 10:00:01", 2, 1),
                ("2024-01-05 10:00:02", 3, 2), ("2024-01-05 10:00:03", 1, 2))
    banned = spark.createDataFrame([("1",), ("3",), ("9",)], "user_id string")
    assert rows(ads.drop_blacklisted(cl, banned), "event_id", "user_id") == [(1, "2")]
    # an empty list keeps every click
    none = spark.createDataFrame([], "user_id string")
    assert ads.drop_blacklisted(cl, none).count() == 4


def test_a_misdated_click_does_not_move_the_hour(spark):
    from pyspark.sql import functions as F

    cl = clicks(spark, ("2024-01-05 12:30:00", 1, 1), ("2024-01-05 11:40:00", 2, 1), ("2100-01-01 00:00:00", 3, 2))
    assert rows(ads.last_hour_trend(cl, 60)) == [("2", "2100-01-01 00:00", 1)]
    recent = ads.recent_minutes(cl, 60, as_of=F.lit("2024-01-06").cast("timestamp"))
    assert rows(recent, "ads_id", "n") == [("1", 1), ("1", 1)]


def test_clean_clicks_does_not_shuffle_the_log_by_user(spark):
    """Initial plan: the log's rows reach the result without an exchange."""
    from helpers import SF01

    from shoplens.sources.tables import FixtureTables

    plan = ads.clean_clicks(FixtureTables(spark, SF01).ads_click(), 3)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in above and "Exchange hashpartitioning" not in above
    assert "SortMergeJoin" not in plan


def test_bloom_filter_rules_out_most_and_loses_no_key(spark):
    keys = spark.range(0, 4000, 2).selectExpr("cast(id as string) AS user_id")
    tested = ads.may_hold(spark.range(0, 40_000).selectExpr("cast(id as string) AS user_id", "id"), "user_id", keys, blocks=4)
    found = {r.id for r in tested.where("maybe").collect()}
    members = set(range(0, 4000, 2))
    assert members <= found and len(found - members) < 0.02 * 38_000
    assert tested.count() == 40_000
    assert ads.may_hold(keys, "user_id", keys.limit(0)).where("maybe").count() == 0


def test_long_ban_list_equals_plain_anti_join(spark):
    from helpers import SF01

    from shoplens.sources.tables import FixtureTables

    cl = FixtureTables(spark, SF01).ads_click()
    users = ads.blacklist(cl, 2)
    expect = rows(cl.join(users, "user_id", "left_anti"), "event_id")
    assert rows(ads.drop_blacklisted(cl, users, max_bytes=-1), "event_id") == expect
    assert rows(ads.drop_blacklisted(cl, users), "event_id") == expect
    # a null user is on no list; a hot banned user goes in full, a hot clean one stays
    odd = cl.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, None).when(F.col("event_id") % 3 == 1, "hot").otherwise("ok"))
    banned = spark.createDataFrame([("hot",), (None,)], "user_id string")
    got = ads.drop_blacklisted(odd, banned, max_bytes=-1)
    assert got.columns == odd.columns and got.count() == odd.where("event_id % 3 != 1").count()


def test_long_ban_list_shuffles_unsure_clicks_only(spark):
    from helpers import SF01

    from shoplens.sources.tables import FixtureTables

    cl = FixtureTables(spark, SF01).ads_click()
    df = ads.drop_blacklisted(cl, ads.blacklist(cl, 4), max_bytes=-1)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    passed = plan[plan.index("Union"):]
    # The clicks that pass are probed and projected in their scan's stage.
    assert "Exchange" not in passed[:passed.index("BroadcastHashJoin")]
    assert "bitmap_construct_agg" in plan and plan.count("SortMergeJoin") == 1
