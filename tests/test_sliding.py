"""The sliding hour: step function and full windows against brute force, stream = batch."""

import datetime as dt
import os
import random

from helpers import clicks, rows
from pyspark.sql import functions as F

from shoplens.operators import ads
from shoplens.sources.adlog import read_ad_stream
from shoplens.streaming.pipeline import AdsStreamJob


def _times(seed, n, hours):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 5, 9, 59, 50)
    return [(t0 + dt.timedelta(seconds=rng.randrange(0, int(hours * 3600)), milliseconds=rng.choice([0, 0, 1, 999])), f"u{i}", rng.choice("ab")) for i in range(n)]


def brute_steps(events, minutes, seconds):
    length, slide, zero = dt.timedelta(minutes=minutes), dt.timedelta(seconds=seconds), dt.datetime(2024, 1, 1)
    out = set()
    for ad in {a for _, _, a in events}:
        mine = [t for t, _, a in events if a == ad]
        ends = {zero + ((t - zero) // slide + 1) * slide for t in mine}
        for e in ends | {e + length for e in ends}:
            out.add((ad, str(e)[:19], sum(e - length <= t < e for t in mine)))
    return sorted(out)


def test_steps_equal_brute_force(spark):
    for seed, n, hours, minutes, seconds in ((1, 120, 5, 60, 10), (2, 200, 0.5, 5, 10), (3, 40, 30, 60, 10), (4, 60, 1, 3, 60)):
        events = _times(seed, n, hours)
        df = clicks(spark, *[(t.isoformat(), u, a) for t, u, a in events])
        assert rows(ads.sliding_hour(df, minutes, seconds)) == brute_steps(events, minutes, seconds)
    # a window is a step: the pane at 10:00:00 exactly starts a new one
    df = clicks(spark, ("2024-01-05 10:00:00", 1, "a"), ("2024-01-05 09:59:59.999", 1, "a"))
    assert rows(ads.sliding_hour(df)) == [("a", "2024-01-05 10:00:00", 1), ("a", "2024-01-05 10:00:10", 2),
                                          ("a", "2024-01-05 11:00:00", 1), ("a", "2024-01-05 11:00:10", 0)]
    assert ads.sliding_hour(df.limit(0)).count() == 0


def test_one_ad_with_every_click(spark):
    """A hot ad: each stretch is summed on its own, from pane counts combined in every task."""
    df = spark.range(200_000).select(
        F.timestamp_seconds(F.lit(1704448800) + F.col("id") % 20_000).alias("ts"), F.lit("hot").alias("ads_id"), F.lit("u").alias("user_id"))
    got = ads.sliding_hour(df).cache()
    at = {r.window_end: r.n for r in got.collect()}
    assert at["2024-01-05 11:00:00"] == 36_000 and at["2024-01-05 10:00:10"] == 100 and min(at.values()) == 0
    assert max(r["n"] for r in ads.pane_counts(df).collect()) == 100


def test_full_windows_agree_with_the_steps(spark):
    events = _times(5, 150, 0.4)
    df = clicks(spark, *[(t.isoformat(), u, a) for t, u, a in events])
    full = ads.sliding_minutes(df, 5, 10).groupBy("ads_id", F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end")).agg(F.sum("n").alias("n"))
    full = {(r.ads_id, r.window_end): r.n for r in full.collect()}
    steps = rows(ads.sliding_hour(df, 5, 10))
    assert all(full.get((a, e), 0) == n for a, e, n in steps)
    # between two steps nothing changes
    for (a, e, n), (b, f, _) in zip(steps, steps[1:]):
        if a == b and n:
            at = dt.datetime.fromisoformat(e)
            while at < dt.datetime.fromisoformat(f):
                assert full[(a, str(at))] == n
                at += dt.timedelta(seconds=10)


def test_stream_equals_batch(spark, tmp_path):
    """Every window the stream has closed is whole and equals the batch form; replays change nothing."""
    src = tmp_path / "in"
    src.mkdir()
    events = sorted(_times(6, 240, 0.5))
    for b in range(4):
        lines = [f"{int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)} A c {u} {a}" for t, u, a in events[b * 60:(b + 1) * 60]]
        p = src / f"part-{b}.txt"
        p.write_text("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + b, 1_700_000_000 + b))
    job = AdsStreamJob(spark, root=str(tmp_path / "out"), limit=10**6, minutes=5, clean_max_files=1, write_files=1, state_partitions=2)
    job.start_guard(read_ad_stream(spark, str(src), max_files_per_trigger=1)).awaitTermination(300)
    job.start_sliding_hour().awaitTermination(300)
    got = job.table("sliding_hour").read().drop("batch_id")
    closed = got.agg(F.max("window_end")).first()[0]
    expect = ads.sliding_minutes(job.clean_batch(), 5, 10).where(F.col("window_end") <= F.lit(closed))
    assert rows(got) == rows(expect) and got.select("window_end").distinct().count() > 60
    # closed up to the lateness before the newest click
    newest = events[-1][0]
    assert newest - closed < dt.timedelta(minutes=2)
    assert rows(job.latest("sliding_hour")) == rows(expect.where(F.col("window_end") == F.lit(closed)))
    assert {r.ads_id for r in job.latest("sliding_hour_json").collect()} == {r.ads_id for r in job.latest("sliding_hour").collect()}
    before = rows(got)
    job.write_sliding(got.limit(1), job.table("sliding_hour").read().agg(F.max("batch_id")).first()[0])
    assert rows(job.table("sliding_hour").read().drop("batch_id")) == before
