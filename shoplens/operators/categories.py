"""Q3 top categories by click / order / pay, Q4 top sessions of those categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import split_ids
from shoplens.plans.joins import maybe_broadcast


def category_events(actions: DataFrame, *keys: str) -> DataFrame:
    """One row per (category, kind) event, from a single scan of the log, with the ``keys`` of its action.

    A row counts for the first kind that applies: a click (``click_category_id
    != -1``), else an order, else a payment.  Order and payment rows carry a
    comma list of category ids; each listed id is one event, repeats included.
    """
    click = F.col("click_category_id") != -1
    order = F.col("order_category_ids").isNotNull()
    pay = F.col("pay_category_ids").isNotNull()
    kind = F.when(click, "click").when(order, "order").when(pay, "pay")
    ids = (F.when(click, F.array(F.col("click_category_id").cast("string")))
           .when(order, split_ids("order_category_ids"))
           .when(pay, split_ids("pay_category_ids")))
    return actions.select(*keys, kind.alias("kind"), F.explode(ids).alias("category_id"))


COUNTS = ["click_count", "order_count", "pay_count"]


def category_counts(actions: DataFrame, *keys: str) -> DataFrame:
    """Click, order and pay counts per category (and keys, e.g. the day); missing kinds count 0."""
    k = F.col("kind")
    return category_events(actions, *keys).groupBy(*keys, "category_id").agg(
        F.count_if(k == "click").alias("click_count"),
        F.count_if(k == "order").alias("order_count"),
        F.count_if(k == "pay").alias("pay_count"),
    )


def merge_counts(counts: DataFrame) -> DataFrame:
    """Counts of several days or sessions as counts per category."""
    return counts.groupBy("category_id").agg(*[F.sum(n).alias(n) for n in COUNTS])


def top_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` first categories of ``category_counts``: clicks desc, orders desc, then payments desc and id."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(int(k))


def category_top(actions: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` categories: clicks desc, orders desc, then payments desc and id.

    The last two keys make the order total (the reference compares clicks and
    orders only, with arbitrary ties).  Planned as TakeOrderedAndProject: each
    task keeps its own top ``k`` and only those reach the final merge.
    """
    return top_counts(category_counts(actions), k)


def category_top_sessions(actions: DataFrame, top: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` sessions with most clicks in each top category.

    ``top`` is the result of ``category_top``; its ``limit`` bounds Catalyst's
    size estimate, which decides whether it is broadcast for the semi join.  Ties on the click count go to the smaller
    session id.  ``row_number() <= k`` lets Catalyst add a partial
    WindowGroupLimit before the shuffle, so a category with many sessions only
    ships each task's top ``k``.
    """
    clicks = actions.where(F.col("click_category_id") != -1).select(
        F.col("click_category_id").cast("string").alias("category_id"), "session_id")
    wanted = clicks.join(maybe_broadcast(top.select("category_id")), "category_id", "left_semi")
    counts = wanted.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return (counts.withColumn("r", F.row_number().over(w))
            .where(F.col("r") <= int(k))
            .select("category_id", "session_id", "click_count"))


def top_category_sessions(actions: DataFrame, categories: int = 10, k: int = 10) -> DataFrame:
    """``category_top`` and ``category_top_sessions`` in one scan of the log.

    Events are counted per (category, session); totals and sessions are both read
    from that aggregate, so its exchange is shared.  Orders and payments need no
    session: all of a category count in one group.  Which categories are wanted is
    not known until all are counted, so each task first prunes every category to
    its ``k`` best sessions (a session outside them can't be among the ``k`` best
    of all); only those are ranked and met by the top categories.

    Against two scans this exchanges the (category, session) pairs of all
    categories, not only of the top ones, and reads the log once.
    """
    kind = F.col("kind")
    click = kind == "click"
    events = category_events(actions, "session_id").select(
        "category_id", F.when(click, F.col("session_id")).alias("session_id"), click.alias("clicked"), "kind").where(F.col("category_id").isNotNull())
    per = events.groupBy("category_id", "session_id", "clicked").agg(
        *[F.count_if(kind == n.split("_")[0]).alias(n) for n in COUNTS])
    top = top_counts(merge_counts(per), categories)
    w = Window.partitionBy("category_id", "clicked").orderBy(F.desc("click_count"), F.asc("session_id"))
    best = per.withColumn("r", F.row_number().over(w)).where(F.col("r") <= int(k))
    # Reads all counts (none is negative): it stays above them, and both uses of ``per`` keep one exchange.
    wanted = F.when(F.col("click_count") + F.col("order_count") + F.col("pay_count") >= 0, F.col("clicked"))
    ranked = best.where(wanted).select("category_id", "session_id", "click_count")
    return ranked.join(maybe_broadcast(top.select("category_id")), "category_id", "left_semi")
