"""The stream run: start the ad-click queries on one line source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shoplens.streaming.pipeline import AdsStreamJob


def _finish(query: StreamingQuery, seconds: float | None) -> None:
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        raise TimeoutError(f"stream query {query.name} did not finish in {seconds} s")


def run_realtime(job: AdsStreamJob, lines: DataFrame, wait_seconds: float | None = None,
                 sliding_hour: bool = False) -> list[StreamingQuery]:
    """Start the guard, totals and last-hour queries, and the sliding hour if asked for.

    With a continuous trigger (``job.trigger``) all run side by side: the
    downstream queries read the guard's clean folder, which only shows whole
    batches.  With the default one-shot ``availableNow`` trigger the guard runs
    first and the downstream queries after it, so that they see all of its
    output.  With ``wait_seconds`` the call waits that long for each query it
    started and raises ``TimeoutError`` if one is not finished by then.
    """
    guard = job.start_guard(lines)
    if job.trigger is None:
        _finish(guard, wait_seconds)
    rest = [job.start_totals(), job.start_last_hour()] + ([job.start_sliding_hour()] if sliding_hour else [])
    if wait_seconds is not None or job.trigger is None:
        for q in ([] if job.trigger is None else [guard]) + rest:
            _finish(q, wait_seconds)
    return [guard, *rest]
