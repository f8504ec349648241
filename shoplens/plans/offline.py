"""The batch run: Q0-Q6 over one table source, results written with a task id.

Q0's filtered log feeds Q1-Q5.  Each job scans its own columns of the stored
log again by default, which costs no copy of it; ``materialize="persist"`` keeps
the filtered log on the executors and ``"checkpoint"`` writes it to the shared
checkpoint folder, for conditions that leave a small part of a large log.

Without a page flow in the conditions Q5 is left out and reported; all other
results are written.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens import api
from shoplens.params import Conditions
from shoplens.plans.queries import filtered_actions
from shoplens.sinks.tables import new_task_id, save_table, with_task_id
from shoplens.sources.tables import ShopTables

Sink = Callable[[str, DataFrame], None]


def parquet_sink(base: str, mode: str = "append") -> Sink:
    """Write each result to ``<base>/<table name>``."""
    def write(name: str, df: DataFrame) -> None:
        save_table(df, f"{base.rstrip('/')}/{name}", mode=mode)
    return write


def offline_results(tables: ShopTables, c: Conditions, actions: DataFrame) -> dict[str, DataFrame]:
    """Result tables of one run, keyed by the reference's table names."""
    stats = api.session_stats(actions, c).select(F.lit(c.to_json()).alias("condition"), "*")
    top = api.category_top(actions, c.top_categories)
    out = {
        "session_stat_info": stats,
        "random_session_info": api.sample_profiles(actions, c),
        "category_top10": top,
        "category_top10_session_count": api.category_top_sessions(actions, top, c.top_sessions),
    }
    if c.page_flow:
        out["page_convert_rate"] = api.page_conversion(actions, c)
    else:
        warnings.warn("no page flow in the conditions: page_convert_rate (Q5) is left out", stacklevel=2)
    # In presentation order: a short result, sorted whole.
    out["area_top3_product"] = api.area_top_products(
        tables.user_visit_action(), tables.city_info(), tables.product_info(), c).orderBy("area", "rk", "product_name").coalesce(1)
    return out


def run_offline(tables: ShopTables, c: Conditions, sink: Sink, task_id: str | None = None,
                materialize: str | None = None) -> str:
    """Run Q1-Q6 and hand each result, tagged with ``task_id``, to ``sink``."""
    task_id = task_id or new_task_id()
    actions = filtered_actions(tables, c)
    if materialize == "persist":
        actions = actions.persist(StorageLevel.MEMORY_AND_DISK)
    elif materialize == "checkpoint":
        actions = actions.checkpoint(eager=True)
    try:
        for name, df in offline_results(tables, c, actions).items():
            sink(name, with_task_id(df, task_id))
    finally:
        if materialize == "persist":
            actions.unpersist()
    return task_id
