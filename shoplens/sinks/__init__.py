"""Result sinks: tables, JDBC, and appended tables for streams."""

from shoplens.sinks.tables import (  # noqa: F401
    new_task_id,
    save_jdbc,
    save_table,
    with_task_id,
    write_bucketed_log,
    write_shop_tables,
)
from shoplens.sinks.appended import AppendedTable  # noqa: F401
from shoplens.sinks.folded import FoldedTable  # noqa: F401
