"""Scalar and list expressions.

Everything here returns a ``Column`` made of built-in functions, so it stays in
whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_up(x) -> Column:
    """Integer rounding, half up, of a non-negative double: ``floor(x + 0.5)``."""
    return F.floor(_c(x) + F.lit(0.5))


def one_decimal(x) -> Column:
    """Round a percent value to one decimal, half up: ``floor(x * 10 + 0.5) / 10``."""
    return F.floor(_c(x) * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def percent_half_up(part, whole) -> Column:
    """``part / whole`` as a percent with one decimal, half up.

    The operation order is ``part / whole * 1000``, add 0.5, floor, ``/ 10`` on
    doubles.  A zero ``whole`` gives 0.0 (ANSI mode would raise on a plain
    division, so ``try_divide`` is used).
    """
    ratio = F.try_divide(_c(part).cast("double"), _c(whole).cast("double"))
    return F.coalesce(F.floor(ratio * F.lit(1000.0) + F.lit(0.5)) / F.lit(10.0), F.lit(0.0))


def split_ids(text) -> Column:
    """Split a comma list the way the reference's string split does.

    Trailing empty parts are dropped, a text made only of commas gives no part,
    an empty text gives one empty part, null gives null (so no row on explode).
    """
    t = _c(text)
    return (F.when(t.isNull(), F.lit(None))
            .when(t.rlike("^,+$"), F.array().cast("array<string>"))
            .otherwise(F.split(F.regexp_replace(t, ",+$", ""), ",")))


def tie_columns(df: DataFrame) -> list[str]:
    """Columns that break ties between actions of the same second.

    Fixture logs carry ``event_id``; a log without it orders ties arbitrarily,
    as the reference does.
    """
    return ["event_id"] if "event_id" in df.columns else []


def ordered_join(value_sql: str, order_sql: list[str], sep: str = ",") -> Column:
    """Aggregate: join the non-null values of a group, ordered by keys.

    ``listagg(value, sep) WITHIN GROUP (ORDER BY keys)``, the SQL standard
    ordered string aggregate (Spark 4).  ``value_sql`` and ``order_sql`` are
    SQL expressions.  Nulls are left out; a group without any value gives null.
    """
    sep_sql = "'" + sep.replace("'", "''") + "'"
    return F.expr(f"listagg({value_sql}, {sep_sql}) WITHIN GROUP (ORDER BY {', '.join(order_sql)})")
