import os

from helpers import rows

from shoplens.sources.adlog import parse_ad_lines, read_ad_stream, valid_clicks
from shoplens.streaming.pipeline import AdsStreamJob


def test_parse_valid_and_quarantine_reasons(spark):
    df = spark.createDataFrame([("1704067200000 AFRICA N1 5 3",),
                                ("1704067200000 AFRICA N1 5",),
                                ("x AFRICA N1 5 3",),
                                ("1704067200000 AFRICA  N1 5 3",),
                                ("1704067200000 AFRICA N1 5 3   ",),
                                ("1704067200000 AFRICA N1 u5 3",),
                                ("1704067200000 AFRICA N1 007 9999999999 sixth",),
                                ("9223372036854775807 AFRICA N1 5 3",),
                                ("92233720368547758079 AFRICA N1 5 3",),
                                ("4102444800000000 AFRICA N1 5 3",),
                                (None,)], "value string")
    got = [(r.is_valid, r.reason) for r in parse_ad_lines(df).collect()]
    assert got == [(True, None), (False, "fewer than 5 fields"), (False, "bad ts"),
                   (True, None), (True, None), (True, None), (True, None),
                   (False, "ts out of range"), (False, "ts out of range"), (False, "ts out of range"),
                   (False, "null line")]
    ok = valid_clicks(parse_ad_lines(df)).collect()
    assert {str(r.ts) for r in ok} == {"2024-01-01 00:00:00"}
    # An inner empty field is an empty text, as the split on one space gives it.
    assert [(r.area, r.city, r.user_id, r.ads_id) for r in ok] == [
        ("AFRICA", "N1", "5", "3"), ("AFRICA", "", "N1", "5"), ("AFRICA", "N1", "5", "3"),
        ("AFRICA", "N1", "u5", "3"), ("AFRICA", "N1", "007", "9999999999")]


def test_ban_applies_from_the_next_micro_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    t0 = 1704067200000
    batches = [
        # batch 0: user 1 reaches the limit (3 clicks on ad 1), plus one more click
        [f"{t0 + i * 1000} A c1 1 1" for i in range(3)] + [f"{t0 + 5000} A c1 1 2", f"{t0} A c1 2 1"],
        # batch 1: user 1 is dropped, user 2 passes
        [f"{t0 + 60000} A c1 1 3", f"{t0 + 60000} A c1 2 2"],
    ]
    for i, lines in enumerate(batches):
        p = src / f"part-{i}.txt"
        p.write_text("\n".join(lines) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    job = AdsStreamJob(spark, root=str(tmp_path / "out"), limit=3)
    job.start_guard(read_ad_stream(spark, str(src), max_files_per_trigger=1)).awaitTermination(300)
    assert rows(job.blacklist_batch()) == [("1",)]
    kept = rows(job.clean_batch(), "user_id", "ads_id")
    assert kept == [("1", "1"), ("1", "1"), ("1", "1"), ("1", "2"), ("2", "1"), ("2", "2")]


def test_run_realtime_one_shot(spark, tmp_path):
    from shoplens.operators import ads
    from shoplens.streaming.realtime import run_realtime

    src = tmp_path / "in"
    src.mkdir()
    t0 = 1704067200000
    (src / "part-0.txt").write_text("\n".join(
        [f"{t0 + i * 60000} A c{i % 2} {i % 3} {i % 2}" for i in range(30)] + ["bad line"]) + "\n")
    job = AdsStreamJob(spark, root=str(tmp_path / "out"), limit=100)
    queries = run_realtime(job, read_ad_stream(spark, str(src)))
    assert len(queries) == 3 and not any(q.isActive for q in queries)
    clean = job.clean_batch()
    assert clean.count() == 30
    assert rows(job.latest("ads_per_day")) == rows(ads.ads_per_day(clean))
    assert rows(job.last_hour_trend()) == rows(ads.last_hour_trend(clean, 60))
    assert job.quarantine_batch().count() == 1


def test_odd_lines_pass_through_while_results_stay_right(spark, tmp_path):
    """An overflowing ts and one of year 130000 go to quarantine, a misdated click does not move the last hour."""
    from shoplens.operators import ads
    from shoplens.streaming.realtime import run_realtime

    src = tmp_path / "in"
    src.mkdir()
    t0 = 1704067200000
    good = [f"{t0 + i * 60000} A c{i % 2} u{i % 3} ad-{i % 2}" for i in range(90)]
    odd = ["9223372036854775807 A c1 1 1", "4102444800000000 A c1 1 1", "4102444800000 A c1 7 ad-0"]   # the last: year 2100
    (src / "part-0.txt").write_text("\n".join(good[:40] + odd + good[40:]) + "\n")
    job = AdsStreamJob(spark, root=str(tmp_path / "out"), limit=100)
    run_realtime(job, read_ad_stream(spark, str(src)), wait_seconds=300)
    assert sorted(r.reason for r in job.quarantine_batch().collect()) == ["ts out of range"] * 2
    clean = job.clean_batch()
    assert clean.count() == 91 and job.ahead_clicks().count() == 1
    assert rows(job.latest("ads_per_day")) == rows(ads.ads_per_day(clean))
    on_time = clean.where("ts < '2100-01-01'")
    assert rows(job.last_hour_trend()) == rows(ads.last_hour_trend(on_time, 60)) and job.last_hour_trend().count() == 60


def test_a_time_out_raises(spark, tmp_path):
    import pytest

    from shoplens.streaming.realtime import run_realtime

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1704067200000 A c 1 1\n")
    job = AdsStreamJob(spark, root=str(tmp_path / "out"))
    with pytest.raises(TimeoutError):
        run_realtime(job, read_ad_stream(spark, str(tmp_path / "in")), wait_seconds=0.01)
    for q in spark.streams.active:
        q.stop()
