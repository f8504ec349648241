"""Inputs shared by the operator tests."""

from __future__ import annotations

SF01 = "/root/testdata/sf0.01"

LONG = "lorem ipsum dolor sit amet " * 20_000 + "password: hunter2Zx9q user@example.com"
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today."),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today."),
    (3, ""),
    (4, None),
    (5, "   \n\t "),
    (6, "!!! ... ###"),
    (7, LONG),
    (8, "one"),
    (9, "Ünïcödé wörds, naïve café 中文 \U0001f600 and spaces"),
    (10, "mail bob@example.com or 10.0.0.1, card 4111 1111 1111 1111, +1 (555) 010-9999"),
    (None, "a document without an id"),
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today."),
]


def edge_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns named like results."""
    rows = [(i, t, "en" if n % 3 else None, None if n % 4 else "s", None, n, "x", n % 2 == 0) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_hit int, spans string, kept boolean").repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
