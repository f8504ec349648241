"""Q0: the filtered visit-action log that feeds Q1-Q5."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.params import Conditions
from shoplens.plans.joins import join_small


def _all(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


def action_predicates(c: Conditions) -> list[Column]:
    """Date bounds on the action log; each end optional, both inclusive."""
    preds = []
    if c.start_date:
        preds.append(F.col("date") >= F.lit(c.start_date))
    if c.end_date:
        preds.append(F.col("date") <= F.lit(c.end_date))
    return preds


def user_predicates(c: Conditions) -> list[Column]:
    """Age bounds on the user table; each end optional, both inclusive."""
    preds = []
    if c.start_age is not None:
        preds.append(F.col("age") >= F.lit(int(c.start_age)))
    if c.end_age is not None:
        preds.append(F.col("age") <= F.lit(int(c.end_age)))
    return preds


def filter_actions(actions: DataFrame, users: DataFrame, c: Conditions) -> DataFrame:
    """Actions of known users inside the date and age bounds.

    The inner join drops actions of users missing from ``users`` (as the
    reference's SQL join does); ``users`` is expected to be unique per
    ``user_id``.  Only ``user_id`` of the filtered users takes part in the join,
    and it is broadcast only when its size check passes.
    """
    cols = actions.columns
    a_pred, u_pred = _all(action_predicates(c)), _all(user_predicates(c))
    if a_pred is not None:
        actions = actions.where(a_pred)
    if u_pred is not None:
        users = users.where(u_pred)
    return join_small(actions, users.select("user_id"), "user_id", "inner").select(*cols)
