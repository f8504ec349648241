"""Join helpers: broadcast a side only behind a size check.

``join_small`` asks Catalyst for the optimized plan's size estimate of the side
meant to be broadcast (file sizes of the scanned parquet after column pruning,
bounded above by ``limit x row width`` when the plan has a limit).  Under the
limit the side is hinted for broadcast; above it no hint is given and the
planner uses a shuffle join, where AQE can still switch to a broadcast from
measured shuffle sizes or split skewed partitions.  Where a row bound is counted or follows from the parameters,
``broadcast_rows`` compares that many rows with the same limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Estimated bytes up to which a join side is broadcast (overridable per session
# with ``shoplens.broadcast.maxBytes``).
DEFAULT_MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def estimated_size(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` in bytes, or None when unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # e.g. Spark Connect, where the JVM plan is not reachable
        return None
    # py4j hands a Scala BigInt over as a Python int; keep a text fallback.
    return int(size) if isinstance(size, int) else int(str(size))


def broadcast_limit(df: DataFrame) -> int:
    try:
        v = df.sparkSession.conf.get("shoplens.broadcast.maxBytes", None)
    except Exception:
        v = None
    return int(v) if v else DEFAULT_MAX_BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint ``df`` for broadcast only if its estimated size is under the limit."""
    size = estimated_size(df)
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int | None = None) -> DataFrame:
    """``big.join(small)``, broadcasting ``small`` when its size check passes."""
    return big.join(maybe_broadcast(small, max_bytes), on, how)


def max_rows(df: DataFrame) -> int | None:
    """Row bound Catalyst can prove for ``df`` (limits, local data), else None."""
    try:
        opt = df._jdf.queryExecution().optimizedPlan().maxRows()
        return int(opt.get()) if opt.isDefined() else None
    except Exception:
        return None


def row_bytes(df: DataFrame) -> int:
    """Catalyst's width of a row of ``df``, as its size estimates use it (fixed 8 bytes a row added)."""
    return 8 + sum(int(f.dataType().defaultSize()) for f in df._jdf.queryExecution().analyzed().schema().fields())


def broadcast_rows(df: DataFrame, rows: int, max_bytes: int | None = None) -> DataFrame:
    """Hint a frame of at most ``rows`` rows (counted, or bound by parameters) if they fit the limit."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    return F.broadcast(df) if int(rows) * row_bytes(df) <= limit else df
