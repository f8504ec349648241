import math
import zlib

import pyarrow as pa
from cases import SF01, edge_documents, empty_documents
from pyspark.sql import functions as F

from shoplens.llm import quality


def scored(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    return docs, labels, quality.quality_query(spark, SF01)


def test_held_out_accuracy(spark):
    docs, labels, out = scored(spark)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and out.count() == docs.count()
    assert sum(r.quality == r.predicted for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= quality.GOOD) for r in rows)


def test_ensemble_is_sparse_and_pure_column(spark):
    docs, labels, _ = scored(spark)
    stats = quality.statistics(docs)
    model = quality.fit(stats, labels)
    assert 0 < len(model.rules) < quality.TREES * 2 ** (quality.DEPTH + 1)
    assert all(1 <= len(rule) <= quality.DEPTH for rule, _ in model.rules)
    plan = stats.limit(0).select(model.score())._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in plan and "PythonUDF" not in plan.split("MapInArrow")[0]


def test_compiled_score_equals_the_rules_row_by_row(spark):
    docs, labels, _ = scored(spark)
    stats = quality.statistics(docs.union(docs.limit(1).withColumn("text", F.lit(None).cast("string"))))
    model = quality.fit(stats, labels)
    got, plain, scores = quality.score(stats, model).collect(), {}, {}
    assert len(got) == docs.count() + 1
    for r in got:
        scores.setdefault(r.doc_id, set()).add(round(r.score, 9))
    for r in stats.collect():
        logit = model.intercept
        for rule, weight in model.rules:
            if all(r[name] <= at if op == "<=" else r[name] > at for name, op, at in rule):
                logit += weight
        plain.setdefault(r.doc_id, set()).add(round(1 / (1 + math.exp(-max(-40.0, min(40.0, logit)))), 9))
    assert scores == plain
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in got)


def test_held_out_labels_are_not_read(spark):
    docs, labels, _ = scored(spark)
    spoiled = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    stats = quality.statistics(docs)
    a, b = (quality.fit(stats, x) for x in (labels, spoiled))
    assert a.rules == b.rules and a.intercept == b.intercept


def test_statistics():
    (row,) = quality.text_statistics(pa.array(["One two. Two two two\nOne two. Two two two"]))
    s = dict(zip(quality.STATS, row))
    assert s["distinct_words"] == 4 / 10 and s["distinct_lines"] == 0.5 and s["top_word"] == 0.4 and s["repeated_next"] == 0.2
    assert quality.text_statistics(pa.array([None, ""])).shape == (2, len(quality.STATS))


def test_defined_cases(spark):
    docs = edge_documents(spark)
    stats = quality.statistics(docs)
    one = spark.createDataFrame([(1, 1), (9, 1), (None, 0), (3, None)], "doc_id bigint, quality int")
    out = quality.score(stats, quality.fit(stats, one)).collect()
    assert len(out) == docs.count() and all(r.predicted == 1 for r in out)
    nothing = quality.score(stats, quality.fit(stats, one.limit(0))).collect()
    assert all(r.predicted == 0 for r in nothing)
    assert quality.score(quality.statistics(empty_documents(spark)), quality.QualityModel([], 0.0)).collect() == []
