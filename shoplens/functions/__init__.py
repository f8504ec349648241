"""Column-level helpers shared by the operators (all built-in expressions)."""

from shoplens.functions.core import (  # noqa: F401
    half_up,
    one_decimal,
    ordered_join,
    percent_half_up,
    split_ids,
    tie_columns,
)
