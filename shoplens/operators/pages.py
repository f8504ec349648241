"""Q5: single-step page conversion rate along a target page flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions import percent_half_up, tie_columns
from shoplens.params import Conditions


# Length of the ``yyyy-MM-dd HH:mm:ss`` prefix that cuts a session into pieces.
SPLITS = {"hour": 13, "minute": 16, "second": 19}


def hot_sessions(actions: DataFrame, rows: int = 1_000_000, most: int = 100) -> Column:
    """True for a row of one of the (at most ``most``) sessions of about ``rows`` actions or more.

    One mergeable frequent-items sketch over the session ids, read as a scalar
    subquery; a session that it misses is only worked on less evenly.
    """
    top = actions.agg(F.expr(f"approx_top_k(session_id, {int(most)}, {100 * int(most)})").alias("top"))
    ids = top.select(F.transform(F.filter("top", lambda x: x["count"] >= int(rows)), lambda x: x["item"]).alias("ids")).scalar()
    return F.coalesce(F.array_contains(ids, F.col("session_id")), F.lit(False))


def _piece(split: str, hot: Column | None) -> Column:
    cut = F.substring("action_time", 1, SPLITS[split])
    return cut if hot is None else F.when(hot, cut).otherwise("")


def _sequence(actions: DataFrame, split: str, hot: Column | None = None) -> DataFrame:
    """Each action with its successor inside its (session, piece).

    With ``hot`` only the sessions it marks are cut into pieces; the others are
    one piece each.  Order: time, then the tie key; without a tie key the page
    id makes the order deterministic (equal rows are interchangeable).  Every
    consumer reads the same columns of this window, so their shuffles are one.
    """
    ties = tie_columns(actions)
    rows = actions.select("session_id", _piece(split, hot).alias("piece"),
                          "action_time", *ties, F.col("page_id").alias("pre_page"))
    w_in = Window.partitionBy("session_id", "piece").orderBy("action_time", *(ties or ["pre_page"]))
    return rows.select(
        "session_id", "piece", "pre_page",
        F.lead("pre_page").over(w_in).alias("post_page"),
        F.lead(F.lit(True)).over(w_in).isNull().alias("is_last"),
        (F.row_number().over(w_in) == 1).alias("is_first"),
    )


def _pair_pieces(edges: DataFrame) -> DataFrame:
    """Each piece's last page with the first page of the session's next piece."""
    w_pieces = Window.partitionBy("session_id").orderBy("piece")
    cross = edges.select(F.col("last_page").alias("pre_page"),
                         F.lead("first_page").over(w_pieces).alias("post_page"),
                         F.lead(F.lit(True)).over(w_pieces).alias("has_next"))
    return cross.where(F.col("has_next")).select("pre_page", "post_page")


def _cross_steps(seq: DataFrame) -> DataFrame:
    """Pairs across pieces: a piece's last page and the next piece's first."""
    edges = seq.where(F.col("is_first") | F.col("is_last")).groupBy("session_id", "piece").agg(
        F.max(F.when(F.col("is_first"), F.col("pre_page"))).alias("first_page"),
        F.max(F.when(F.col("is_last"), F.col("pre_page"))).alias("last_page"),
    )
    return _pair_pieces(edges)


def _steps(seq: DataFrame) -> DataFrame:
    inner = seq.where(~F.col("is_last")).select("pre_page", "post_page")
    return inner.unionByName(_cross_steps(seq))


def page_steps(actions: DataFrame, split: str = "minute") -> DataFrame:
    """Every adjacent (pre_page, post_page) pair of each session, in time order.

    The session's sequence is cut into pieces (minutes by default).  Inside a
    piece ``lead`` pairs neighbours; across pieces, each piece's last page
    pairs with the first page of the session's next non-empty piece, found
    with ``lead`` over one summary row per (session, piece).  No task sorts a
    whole session: a piece holds the session's actions of one minute, and the
    summary level holds at most one row per minute the session spans.  The
    result equals ``lead`` over the whole session.  The summary aggregate
    reuses the window's (session, piece) partitioning, so it adds no shuffle.
    """
    return _steps(_sequence(actions, split))


def page_pairs(actions: DataFrame, split: str = "minute") -> DataFrame:
    """How often each page follows each other page: pre_page, post_page, n over all sessions."""
    return page_steps(actions, split).groupBy("pre_page", "post_page").agg(F.count(F.lit(1)).alias("n"))


def flow_pairs(c: Conditions) -> list[tuple[int, int]]:
    """The adjacent pairs of the flow, as a sorted set; raises ``ValueError`` without a flow."""
    flow = c.require_flow()
    return sorted({(int(a), int(b)) for a, b in zip(flow, flow[1:])})


def _counts(pairs) -> tuple[list[int], dict[str, tuple]]:
    """The pages whose visits count, and the count columns of a segment: v0.. a page, j0.. a pair."""
    starts = sorted({a for a, _ in pairs})
    return starts, {**{f"v{i}": (a,) for i, a in enumerate(starts)}, **{f"j{i}": pair for i, pair in enumerate(pairs)}}


def page_segments(actions: DataFrame, pairs: list[tuple[int, int]], split: str = "minute", hot: Column | None = None) -> DataFrame:
    """One row a (session, piece): first and last page, visits of the flow's pages, jumps of its pairs.

    A segment stands for a stretch of a session: two that follow each other merge
    into one by adding their counts and the jump from the first one's last page to
    the second one's first (``merge_segments``), in any grouping.  The aggregate
    keeps the window's partitioning, so the log is exchanged once.
    """
    return _segments(_sequence(actions, split, hot), pairs)


def _segments(seq: DataFrame, pairs) -> DataFrame:
    pre, post = F.col("pre_page"), F.col("post_page")
    test = lambda key: pre == key[0] if len(key) == 1 else (pre == key[0]) & (post == key[1])
    return seq.groupBy("session_id", "piece").agg(
        F.max(F.when(F.col("is_first"), pre)).alias("first_page"),
        F.max(F.when(F.col("is_last"), pre)).alias("last_page"),
        *[F.count_if(test(key)).alias(name) for name, key in _counts(pairs)[1].items()])


def _with_crossings(segments: DataFrame, pairs, within: list[str]) -> DataFrame:
    """The segments, the jump to the next segment of the session counted in each."""
    after = F.lead("first_page").over(Window.partitionBy(*within).orderBy("piece"))
    cross = lambda key: F.coalesce(((F.col("last_page") == key[0]) & (F.col("after") == key[1])).cast("bigint"), F.lit(0))
    out = segments.withColumn("after", after)
    return out.withColumns({n: F.col(n) + cross(key) for n, key in _counts(pairs)[1].items() if len(key) == 2}).drop("after")


def merge_segments(segments: DataFrame, pairs: list[tuple[int, int]], into: Column) -> DataFrame:
    """Segments of the coarser pieces ``into`` (an expression over ``piece`` that keeps its order)."""
    rows = _with_crossings(segments.withColumn("_into", into), pairs, ["session_id", "_into"])
    merged = rows.groupBy("session_id", "_into").agg(
        F.min_by("first_page", "piece").alias("first_page"), F.max_by("last_page", "piece").alias("last_page"),
        *[F.sum(n).alias(n) for n in _counts(pairs)[1]])
    return merged.withColumnRenamed("_into", "piece").select(*segments.columns)


def conversion_from_segments(segments: DataFrame, pairs: list[tuple[int, int]], include_zero: bool = False) -> DataFrame:
    """The rates over all segments: joined in time order a session, then summed into one row."""
    if not pairs:
        return segments.sparkSession.createDataFrame([], "page_jump string, rate double")
    starts, names = _counts(pairs)
    total = _with_crossings(segments, pairs, ["session_id"]).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    rates = total.select(F.inline(F.array(*[F.struct(
        F.lit(f"{a}-{b}").alias("page_jump"), F.col(f"j{i}").alias("jumps"), F.col(f"v{starts.index(a)}").alias("visits"))
        for i, (a, b) in enumerate(pairs)])))
    if not include_zero:
        rates = rates.where(F.col("jumps") > 0)
    return rates.select("page_jump", percent_half_up(F.col("jumps"), F.col("visits")).alias("rate"))


def page_conversion(actions: DataFrame, c: Conditions, include_zero: bool = False,
                    split: str = "minute", hot: Column | None = None) -> DataFrame:
    """Rate of each target jump ``a-b``: jumps a->b over all visits of page a.

    Visits count every action on the page (any session, also as last page).
    Target pairs are the adjacent pairs of the flow, as a set.  Pairs with no
    jump are left out unless ``include_zero``.  Raises ``ValueError`` when no
    flow is given.

    The log is exchanged and sorted once, for its segments; what follows holds one
    row a session (or a piece of those that ``hot`` marks, see ``hot_sessions``).
    """
    pairs = flow_pairs(c)
    return conversion_from_segments(page_segments(actions, pairs, split, hot), pairs, include_zero)
