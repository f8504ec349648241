"""Q6: top clicked products per area, with the city-share remark.

The reference computes the remark with a UDAF that keeps a city -> count map
per group.  Here it is two native aggregations: counts per (area, product,
city), then per (area, product) the total, the number of cities and the two
biggest cities in one window pass (a group holds one row per city, so it is
bounded by the city table).  No map buffer and no list of cities is ever
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import one_decimal, percent_half_up
from shoplens.params import Conditions
from shoplens.plans.joins import join_small


def area_city_clicks(actions: DataFrame, cities: DataFrame, *keys: str) -> DataFrame:
    """Clicks per (area, product, city) and keys, e.g. the day; a click is ``click_product_id > 0``."""
    clicks = actions.where(F.col("click_product_id") > 0).select(
        *keys, "city_id", F.col("click_product_id").alias("product_id"))
    joined = join_small(clicks, cities.select("city_id", "city_name", "area"), "city_id")
    return joined.groupBy(*keys, "area", "product_id", "city_name").agg(F.count(F.lit(1)).alias("n"))


def merge_city_clicks(counts: DataFrame) -> DataFrame:
    """Counts of several days as counts per (area, product, city)."""
    return counts.groupBy("area", "product_id", "city_name").agg(F.sum("n").alias("n"))


def city_share(actions: DataFrame, cities: DataFrame, c: Conditions) -> DataFrame:
    """Per (area, product): click total ``cnt`` and the remark text.

    Remark: ``cityA:p1,cityB:p2`` for the two cities with most clicks (ties by
    name), shares in percent with one decimal, half up; when more than two
    cities clicked, ``,<other>:p`` follows with ``100 - p1 - p2`` rounded to
    one decimal.  (The reference always appended the "other" part and scaled
    it by 100 too much; both are fixed.)
    """
    return share_of_clicks(area_city_clicks(actions, cities), c)


def share_of_clicks(pc: DataFrame, c: Conditions) -> DataFrame:
    """``city_share`` from the counts per (area, product, city)."""
    # One pass over the (area, product, city) counts: a group has at most one
    # row per city, so its size is bounded by the city table, not the log.
    w_all = Window.partitionBy("area", "product_id")
    w_ord = w_all.orderBy(F.desc("n"), F.asc("city_name"))
    r = F.col("r")
    ranked = pc.select(
        "area", "product_id", "city_name", "n",
        F.sum("n").over(w_all).alias("cnt"),
        F.count(F.lit(1)).over(w_all).alias("n_cities"),
        F.row_number().over(w_ord).alias("r"),
    ).where(r <= 2)
    j = ranked.groupBy("area", "product_id").agg(
        F.max("cnt").alias("cnt"),
        F.max("n_cities").alias("n_cities"),
        F.max(F.when(r == 1, F.col("city_name"))).alias("city1"),
        F.max(F.when(r == 1, F.col("n"))).alias("n1"),
        F.max(F.when(r == 2, F.col("city_name"))).alias("city2"),
        F.max(F.when(r == 2, F.col("n"))).alias("n2"))
    p1 = percent_half_up(F.col("n1"), F.col("cnt"))
    p2 = percent_half_up(F.col("n2"), F.col("cnt"))
    part1 = F.concat(F.col("city1"), F.lit(":"), p1.cast("string"))
    part2 = F.when(F.col("city2").isNotNull(),
                   F.concat(F.lit(","), F.col("city2"), F.lit(":"), p2.cast("string"))).otherwise("")
    other = F.when(F.col("n_cities") > 2,
                   F.concat(F.lit("," + c.other_label + ":"),
                            one_decimal(F.lit(100.0) - p1 - p2).cast("string"))).otherwise("")
    return j.select("area", "product_id", "cnt", F.concat(part1, part2, other).alias("remark"))


def area_top_products(shares: DataFrame, products: DataFrame, k: int = 3) -> DataFrame:
    """Products ranked by clicks inside each area, ``rank() <= k`` (ties kept).

    Product names are joined after ranking, so a ranked product missing from
    ``products`` drops out and leaves a gap in the ranks, as in the reference.
    """
    w = Window.partitionBy("area").orderBy(F.desc("cnt"))
    ranked = shares.withColumn("rk", F.rank().over(w)).where(F.col("rk") <= int(k))
    named = join_small(ranked, products.select("product_id", "product_name"), "product_id")
    return named.select("area", "product_name", "cnt", "rk", "remark")
