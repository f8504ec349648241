import os

import pytest
from helpers import SF001, rows
from pyspark.sql import functions as F

from shoplens.params import DEFAULT_CONDITIONS, Conditions
from shoplens.plans.offline import offline_results, parquet_sink, run_offline
from shoplens.plans.queries import filtered_actions
from shoplens.sinks import AppendedTable, with_task_id
from shoplens.sources.tables import FixtureTables


def test_offline_run_writes_every_table_with_task_id(spark, tmp_path):
    tables = FixtureTables(spark, SF001)
    out = str(tmp_path / "results")
    task = run_offline(tables, DEFAULT_CONDITIONS, parquet_sink(out), task_id="t-1")
    assert task == "t-1"
    expect = offline_results(tables, DEFAULT_CONDITIONS, filtered_actions(tables, DEFAULT_CONDITIONS))
    assert sorted(os.listdir(out)) == sorted(expect)
    for name, df in expect.items():
        got = spark.read.parquet(f"{out}/{name}")
        assert got.columns == ["task_id", *df.columns]
        assert {r.task_id for r in got.select("task_id").distinct().collect()} == {"t-1"}
        assert rows(got.drop("task_id")) == rows(df)


def test_offline_run_with_checkpointed_actions(spark, tmp_path):
    tables = FixtureTables(spark, SF001)
    out = str(tmp_path / "results")
    run_offline(tables, DEFAULT_CONDITIONS, parquet_sink(out), task_id="t-2", materialize="checkpoint")
    assert spark.read.parquet(f"{out}/page_convert_rate").count() > 0


def test_appended_table(spark, tmp_path):
    t = AppendedTable(spark, str(tmp_path / "t"), "k int, n bigint")
    newest = lambda r: r.groupBy("k").agg(F.max("n").alias("n"))
    frame = lambda *x: spark.createDataFrame(list(x), "k int, n bigint")
    assert t.read().count() == 0
    assert t.append(frame((1, 1), (2, 1)), 0) and t.append(frame((1, 3)), 1) and t.append(frame((3, 1)), 2)
    assert not t.append(frame((9, 9)), 1)                   # replayed batch: left alone
    assert rows(newest(t.read())) == [(1, 3), (2, 1), (3, 1)]
    assert rows(newest(t.read(before=1))) == [(1, 1), (2, 1)] and rows(newest(t.read(upto=1))) == [(1, 3), (2, 1)]


def test_compaction_keeps_the_newest_batch_and_all_rows(spark, tmp_path):
    t = AppendedTable(spark, str(tmp_path / "t"), "k int, n bigint")
    newest = lambda r: r.groupBy("k").agg(F.max("n").alias("n"))
    for b in range(6):
        t.append(spark.createDataFrame([(b % 3, b + 1)], "k int, n bigint"), b)
        if b in (2, 4):
            before = rows(newest(t.read()))
            t.compact(newest)
            assert rows(newest(t.read())) == before and t.has(b)
    names = sorted(n for n in os.listdir(tmp_path / "t") if n.startswith("batch_id="))
    assert len(names) == 3 and {"batch_id=4", "batch_id=5"} < set(names)
    assert rows(newest(t.read())) == [(0, 4), (1, 5), (2, 6)]


def test_offline_run_without_a_flow_writes_the_rest(spark, tmp_path):
    tables, out = FixtureTables(spark, SF001), str(tmp_path / "results")
    with pytest.warns(UserWarning, match="page flow"):
        run_offline(tables, Conditions(), parquet_sink(out))
    names = os.listdir(out)
    assert "page_convert_rate" not in names and len(names) == 5
    top = spark.read.parquet(f"{out}/area_top3_product")
    (part,) = [n for n in os.listdir(f"{out}/area_top3_product") if n.endswith(".parquet")]
    got = [(r.area, r.rk, r.product_name) for r in spark.read.parquet(f"{out}/area_top3_product/{part}").collect()]
    assert got == sorted(got) and len(got) == top.count()


def test_with_task_id_puts_id_first(spark):
    df = with_task_id(spark.createDataFrame([(1,)], "x int"), "run")
    assert df.columns == ["task_id", "x"] and df.collect()[0].task_id == "run"


def test_bucketed_log_is_grouped_by_session_without_an_exchange(spark, tmp_path):
    from shoplens.operators import pages, sessions
    from shoplens.sinks import write_bucketed_log
    from shoplens.sources.tables import StoredTables

    tables = FixtureTables(spark, SF001)
    log = tables.user_visit_action()
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    try:
        write_bucketed_log(log, "bucketed.user_visit_action", 4, str(tmp_path / "log"), hot=pages.hot_sessions(log, rows=10))
        stored = StoredTables(spark, database="bucketed").user_visit_action(DEFAULT_CONDITIONS.start_date, DEFAULT_CONDITIONS.end_date)
        plain = tables.user_visit_action(DEFAULT_CONDITIONS.start_date, DEFAULT_CONDITIONS.end_date)
        jobs = {"lengths": sessions.session_lengths, "profile": sessions.session_profile,
                "pages": lambda a: pages.page_conversion(a, DEFAULT_CONDITIONS)}
        for name, job in jobs.items():
            df = job(stored)
            assert rows(df) == rows(job(plain)), name
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan, (name, plan)
            assert "hashpartitioning(session_id" in job(plain)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP DATABASE bucketed CASCADE")
