"""A bounded, hash-picked sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELS = 50_000


def label_sample(labels: DataFrame, column: str, parts: int, part: int, max_labels: int = MAX_LABELS) -> DataFrame:
    """``doc_id, label`` (0/1) of at most ``max_labels`` labelled ids that may be learned from.

    Ids with ``crc32(doc_id as text) mod parts = part`` are left out.  All others
    are taken while they fit; beyond, the ids of least hash, in expectation 95 %
    of the bound.  Repeated ids count once (greatest label); null labels or ids never.
    """
    rows = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels[column].cast("int").alias("label"))
    rows = rows.where("doc_id is not null and label in (0, 1)").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) != part)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = rows.count()
    if n > max_labels:
        share = int((1 << 30) * 0.95 * max_labels / n)
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    return rows.limit(max_labels)
