"""Folded counters: sums, replays, folding, expiry, and flat cost over many batches of the guard."""

import os

import pytest
from helpers import rows

from shoplens.sinks.appended import file_system
from shoplens.sinks.folded import REST, FoldedTable
from shoplens.sources.adlog import read_ad_stream
from shoplens.streaming.pipeline import AdsStreamJob, summed_counts

COUNTERS = "user_id string, ads_id string, day string, n bigint"


def table(spark, path, **kw):
    return FoldedTable(spark, str(path), COUNTERS, summed_counts, part="day", **kw)


def batch(spark, *items):
    return spark.createDataFrame(list(items), COUNTERS)


def test_sums_over_batches_and_folds(spark, tmp_path):
    t = table(spark, tmp_path / "c", fold_every=3)
    expect = {}
    for b in range(10):
        day = f"2024-01-0{1 + b % 2}"
        assert t.append(batch(spark, ("u", "1", day, b + 1), (f"u{b}", "1", day, 1)), b, [day])
        for k, n in ((("u", "1", day), b + 1), ((f"u{b}", "1", day), 1)):
            expect[k] = expect.get(k, 0) + n
        assert {(r.user_id, r.ads_id, r.day): r.n for r in t.read().collect()} == expect
        assert len(t.paths()) <= 2 * 3
    assert rows(t.read(["2024-01-01"]), "n") == sorted((n,) for k, n in expect.items() if k[2] == "2024-01-01")
    t.compact()
    assert len(t.paths()) == 2 and {(r.user_id, r.ads_id, r.day): r.n for r in t.read().collect()} == expect


def test_a_replay_reads_what_the_first_run_read(spark, tmp_path):
    t = table(spark, tmp_path / "c", fold_every=2)
    seen = []
    for b in range(9):
        seen.append(rows(t.read(["d", REST], before=b)))
        t.append(batch(spark, ("u", "1", "d", 1)), b, ["d"])
        assert rows(t.read(["d", REST], before=b)) == seen[-1]          # the last batch can be run again
        assert not t.append(batch(spark, ("u", "1", "d", 99)), b, ["d"])
    assert rows(t.read(), "n") == [(9,)]


def test_a_stop_before_the_mark_is_completed(spark, tmp_path):
    t = table(spark, tmp_path / "c")
    t.append(batch(spark, ("u", "1", "a", 1), ("u", "1", "b", 1)), 0, ["a", "b"])
    t._fs.delete(t._Path(f"{t.path}/done/0"), True)
    t._fs.delete(t._Path(f"{t.path}/part=b/inc-0"), True)
    assert t.append(batch(spark, ("u", "1", "a", 1), ("u", "1", "b", 1)), 0, ["a", "b"])
    assert rows(t.read(), "day", "n") == [("a", 1), ("b", 1)]


def test_rows_of_unnamed_days_share_a_part(spark, tmp_path):
    t = table(spark, tmp_path / "c")
    t.append(batch(spark, ("u", "1", "a", 1), ("u", "1", "x", 2), ("u", "1", "y", 3)), 0, ["a"])
    assert t.parts() == ["a", REST]
    t.append(batch(spark, ("u", "1", "x", 4)), 1, ["x"])
    assert rows(t.read(["x", REST]), "day", "n") == [("x", 6), ("y", 3)]
    assert t.expire("b") == ["a"] and t.parts() == [REST, "x"]


def test_stores_that_copy_on_rename_are_refused(spark):
    class Fs:
        def getScheme(self):
            return "s3a"

    class Path:
        def __init__(self, p):
            pass

        def getFileSystem(self, conf):
            return Fs()

    class Fake:
        class _jvm:
            class org:
                class apache:
                    class hadoop:
                        class fs:
                            pass

        class _jsc:
            @staticmethod
            def hadoopConfiguration():
                return None

    Fake._jvm.org.apache.hadoop.fs.Path = Path
    with pytest.raises(ValueError, match="atomic rename"):
        file_system(Fake, "s3a://bucket/x")


def test_guard_reads_flat_over_fifty_batches(spark, tmp_path):
    """The same users click on, a day every ten batches: what a batch reads stays level, and old days are not read."""
    src, base = tmp_path / "in", 1704067200000
    src.mkdir()
    for b in range(50):
        t = base + (b // 10) * 86_400_000 + (b % 10) * 60_000
        p = src / f"part-{b:03d}.txt"
        bad = "".join(f"{t + i} A c bad{b} 1\n" for i in range(12))
        p.write_text("".join(f"{t + i} A c u{i % 40} {i % 3}\n" for i in range(120)) + bad)
        os.utime(p, (1_700_000_000 + b, 1_700_000_000 + b))
    job = AdsStreamJob(spark, root=str(tmp_path / "out"), limit=11, write_files=1, fold_every=4, counter_days=1)
    counters, bans, cost = job.table("counters"), job.table("bans"), []
    write = job.write_guard

    def measured(lines, batch_id):
        mine = counters.paths([f"2024-01-{1 + batch_id // 10:02d}", REST], before=batch_id)
        cost.append((counters.size(mine), len(mine), len(bans.paths(before=batch_id))))
        write(lines, batch_id)

    job.write_guard = measured
    job.start_guard(read_ad_stream(spark, str(src), max_files_per_trigger=1)).awaitTermination(600)
    assert len(cost) == 50 and max(n for _, n, _ in cost) <= 5 and max(n for _, _, n in cost) <= 5
    for day in range(5):                                     # every day costs the same, batch by batch
        assert [c for c, _, _ in cost[day * 10:day * 10 + 10]][0] == 0
        assert max(c for c, _, _ in cost[day * 10:day * 10 + 10]) <= 1.1 * max(c for c, _, _ in cost[:10])
    assert counters.parts() == ["2024-01-04", "2024-01-05"]
    assert rows(job.blacklist_batch()) == sorted((f"bad{b}",) for b in range(50))
    assert job.clean_batch().count() == 50 * 132             # each is banned from the batch after its own
