"""License scans: phrases, and templates by an exact set-similarity join (op 13).

Only DataFrame functions: no Python runs on the executors.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z.  Base
labels come from phrases whose words stand consecutively.  The method adds labels of
notices that are reworded, wrapped or cut a little: a text block that holds at least
``PERCENT`` of a template's different words.

Text blocks are windows of the whole word sequence, whatever its lines: for
templates of at most ``m`` words (a power of two) a block of ``2 m`` words begins at
every ``m``-th word, so any passage of ``m`` words lies whole in a block.

The join is exact.  Template words are ordered by the number of documents that hold
them, rarest first, counted over all documents.  With ``need`` common words wanted:

* prefix: a block and a template that meet ``need`` share a word among the first
  ``size - need + 1`` of either; only blocks around such words of a template are
  ever built, and only such pairs are joined;
* length: a block with fewer than ``need`` template words is left out;
* position: the words after the shared one, on the shorter side, must suffice;
* what is left is compared on the full sets.

Templates are a parameter, a fixed list by default; that side is broadcast if its
size check passes.  Blocks of common words are spread like any others.

Defined cases: null or word-less text has 0 words, no label and score 0; repeated
rows get a row each; an empty table gives no rows; a text of any length is read
whole; equal scores need no order, labels are a set; other input columns are
ignored.  The score is the greatest share of a template found, 1 for a phrase.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.staging import Staging, documents, keys_and_text
from shoplens.plans.joins import maybe_broadcast

# The contract's phrases.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# The usual notices of each license.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]

PERCENT = 90                    # of a template's different words
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    parts = F.split(F.translate(text, _UPPER, _LOWER), _SEPARATORS, -1)
    # Only the first and the last part can be empty.
    return F.element_at(F.transform(F.array(parts), lambda p: F.slice(
        p, F.when(F.get(p, F.lit(0)) == "", 2).otherwise(1),
        F.greatest(F.lit(0), F.size(p) - (F.get(p, F.lit(0)) == "").cast("int") - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")))), 1)


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def phrase_places(words: Column, phrase: str) -> Column:
    """Starts of the places (words from 0) where the phrase's words stand consecutively."""
    own = phrase.split(" ")
    rare = max(own, key=len)
    fits = lambda i: F.forall(F.array(*[F.get(words, i + k) == F.lit(w) for k, w in enumerate(own)]), lambda x: F.coalesce(x, F.lit(False)))
    places = F.filter(F.transform(words, lambda w, i: F.when(w == own[0], i)), lambda i: F.when(i.isNotNull(), fits(i)).otherwise(F.lit(False)))
    return F.when(F.array_contains(words, rare), places).otherwise(F.array().cast("array<int>"))


class Templates:
    """Templates as word sets in one global order, with what the filters need of each."""

    def __init__(self, templates: list[tuple[str, str]], percent: int = PERCENT):
        self.percent = percent
        self.sets, self.width, self.labels = [], [], []
        for label, text in templates:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(_UPPER, _LOWER)))
            if words:
                self.labels.append(label)
                self.sets.append(set(words))
                self.width.append(max(8, 1 << (len(words) - 1).bit_length()))
        self.vocabulary = sorted(set().union(*self.sets)) if self.sets else []

    def need(self, k: int) -> int:
        return -(-self.percent * len(self.sets[k]) // 100)

    def order(self, frequency: dict[str, int]) -> None:
        """Sorts all by document frequency, rarest first."""
        self.vocabulary.sort(key=lambda w: (frequency.get(w, 0), w))
        place = {w: i for i, w in enumerate(self.vocabulary)}
        self.ordered = [sorted(s, key=place.__getitem__) for s in self.sets]

    def prefix(self, k: int) -> list[str]:
        return self.ordered[k][:len(self.sets[k]) - self.need(k) + 1]

    def widths(self) -> list[int]:
        return sorted(set(self.width))

    def least_need(self, width: int) -> int:
        return min(self.need(k) for k, w in enumerate(self.width) if w == width)

    def anchors(self, width: int) -> list[str]:
        return sorted({w for k, m in enumerate(self.width) if m == width for w in self.prefix(k)})

    def table(self, spark) -> DataFrame:
        """One row a template and prefix word: m, token, i (its place), need, label, tokens."""
        rows = [{"m": self.width[k], "token": w, "i": i, "need": self.need(k), "label": self.labels[k], "tokens": self.ordered[k]}
                for k in range(len(self.sets)) for i, w in enumerate(self.prefix(k))]
        schema = "array<struct<m: int, token: string, i: int, need: int, label: string, tokens: array<string>>>"
        return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> DataFrame:
    """token, n: in how many rows of the array column ``words`` each word of the vocabulary stands."""
    held = words.select(F.explode(F.array_intersect("words", _texts(vocabulary))).alias("token"))
    return held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def anchored_blocks(words: Column, templates: Templates) -> Column:
    """The text blocks that hold a prefix word: array of (m, b, w), w the block's template words in global order."""
    none = F.from_json(F.lit("[]"), "array<struct<m: int, b: int, w: array<string>>>")

    def of_width(m: int) -> Column:
        wanted = templates.anchors(m)
        at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(wanted), i)), lambda i: i.isNotNull())
        cells = F.array_distinct(F.transform(at, lambda i: F.floor(i / F.lit(m)).cast("int")))
        # A word lies in the block that begins in its own cell and in the one before.
        begins = F.filter(F.array_distinct(F.concat(cells, F.transform(cells, lambda c: c - 1))), lambda c: c >= 0)
        blocks = F.transform(begins, lambda b: F.struct(F.lit(m).alias("m"), b.alias("b"), F.array_intersect(
            _texts(templates.vocabulary), F.slice(words, b * m + 1, F.lit(2 * m))).alias("w")))
        return F.when(F.arrays_overlap(words, _texts(wanted)), blocks).otherwise(none)

    return F.concat(none, *[of_width(m) for m in templates.widths()])


def containment_join(blocks: DataFrame, templates: Templates) -> DataFrame:
    """All (block, template) pairs with enough common words: the columns of ``blocks``, label, share.

    ``blocks`` has m, and w in global order.  A pair comes once for each shared prefix word.
    """
    size = F.size("w")
    least = F.lit(None).cast("int")
    for m in templates.widths():
        least = F.when(F.col("m") == m, templates.least_need(m)).otherwise(least)
    keyed = blocks.withColumn("size", size).where(size >= least).select(
        "*", F.posexplode(F.slice("w", F.lit(1), size - least + 1)).alias("j", "token"))
    side = maybe_broadcast(templates.table(blocks.sparkSession))
    after = 1 + F.least(F.size("tokens") - F.col("i") - 1, F.col("size") - F.col("j") - 1)
    pairs = keyed.join(side, ["m", "token"]).where((F.col("size") >= F.col("need")) & (after >= F.col("need")))
    pairs = pairs.withColumn("common", F.size(F.array_intersect("w", "tokens"))).where("common >= need")
    return pairs.select(*blocks.columns, "label", (F.col("common") / F.size("tokens")).alias("share"))


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Per row: words, phrase places, labels of the phrases, labels of phrases and templates, score."""
    st = Staging(docs.sparkSession, "licenses")
    known = Templates(templates, percent)
    worded = keys_and_text(docs).select("doc_id", words_of(F.coalesce("text", F.lit(""))).alias("words"))
    known.order({r["token"]: r["n"] for r in document_frequencies(worded, known.vocabulary).collect()})   # one row a template word

    places = worded.select("doc_id", "words", *[phrase_places(F.col("words"), p).alias(f"p{k}") for k, (_, p) in enumerate(PHRASES)])
    all_places = F.concat(*[F.col(f"p{k}") for k in range(len(PHRASES))])
    base = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, (label, _) in enumerate(PHRASES)]), lambda x: x.isNotNull())
    scan = st.save(places.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.size("words").cast("bigint").alias("n_words"),
        F.size(all_places).cast("bigint").alias("n_base"), F.array_min(all_places).cast("bigint").alias("first_word"),
        F.array_max(all_places).cast("bigint").alias("last_word"), F.array_sort(base).alias("base"),
        anchored_blocks(F.col("words"), known).alias("blocks")), "scan")

    blocks = scan.select("rid", F.inline("blocks"))
    found = containment_join(blocks, known).groupBy("rid").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    out = scan.drop("blocks").join(found, "rid", "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.coalesce("share", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                      F.array_join(labels, ",").alias("labels"), score.alias("score"))


def license_query(spark, sf_dir: str) -> DataFrame:
    return find_licenses(documents(spark, sf_dir))


def _oracle() -> str:
    t = Templates(TEMPLATES)
    rows = ", ".join(f"({k}, '{t.labels[k]}', {t.width[k]}, {len(s)}, {t.need(k)}, '{w}')" for k, s in enumerate(t.sets) for w in sorted(s))
    phrases = "\n  UNION ALL ".join(
        f"SELECT id, '{label}' AS label, i FROM l, unnest(range(len(w))) AS t(i) WHERE w[i + 1:i + {len(p.split())}] = {p.split()}" for label, p in PHRASES)
    return rf"""
WITH t(k, label, m, size, need, word) AS (VALUES {rows}),
l AS MATERIALIZED (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS MATERIALIZED ({phrases}),
x AS (SELECT id, unnest(w) AS word, unnest(range(len(w))) AS i FROM l),
y AS (SELECT id, k, label, size, need, x.word, i // m AS b FROM x JOIN t USING (word) UNION ALL SELECT id, k, label, size, need, x.word, i // m - 1 FROM x JOIN t USING (word)),
z AS (SELECT id, label, size, count(DISTINCT word) AS n FROM y WHERE b >= 0 GROUP BY id, k, label, size, need, b HAVING count(DISTINCT word) >= need),
b AS (SELECT id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY id),
a AS (SELECT id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM (SELECT id, label, 1.0::DOUBLE AS score FROM p UNION ALL SELECT id, label, n::DOUBLE / size FROM z) GROUP BY id)
SELECT l.id AS doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM l LEFT JOIN b USING (id) LEFT JOIN a USING (id)
"""


ORACLE = _oracle()
