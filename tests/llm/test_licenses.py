"""Phrases and the set-similarity join against a brute-force version, defined cases."""

import random
import re

import pytest
from cases import LONG, SF01, TEXTS, edge_documents, empty_documents

from shoplens.llm import licenses as li

SCHEMA = "doc_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(text, templates=li.TEMPLATES, percent=li.PERCENT):
    w = words(text)
    places, base, more, score = [], set(), set(), 0.0
    for label, phrase in li.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        if at:
            base.add(label)
            score = 1.0
    for label, t in templates:
        own = set(words(t))
        m = 8
        while m < len(words(t)):
            m *= 2
        for b in range(0, len(w), m):
            share = len(own & set(w[b:b + 2 * m]))
            if 100 * share >= percent * len(own):
                more.add(label)
                score = max(score, share / len(own))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), score)


def as_tuple(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)


NOTICES = [t for _, t in li.TEMPLATES]


def noisy(rng):
    """Filler with notices that are whole, wrapped, reordered, or lack or change some words."""
    out = [rng.choice(["lorem", "ipsum", "the", "license", "under", "of"]) for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(0, 3)):
        w = rng.choice(NOTICES).split()
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(len(w))
            w[k:k + 1] = rng.choice([[], ["changed"], [w[k].upper()], [w[k] + "\n"], ["x", w[k]]])
            if not w:
                break
        if rng.random() < 0.2:
            rng.shuffle(w)
        k = rng.randrange(len(out) + 1)
        out[k:k] = w
    return " ".join(out)


def test_against_brute_force(spark):
    rng = random.Random(11)
    rows = [(i, noisy(rng)) for i in range(400)]
    got = {r.doc_id: as_tuple(r) for r in li.find_licenses(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert got == {i: brute(t) for i, t in rows}
    assert len({g[5] for g in got.values()}) > 8


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_other_templates_and_thresholds(spark, percent):
    rng = random.Random(percent)
    letters = "abcdefghij"
    templates = [(f"t{k}", " ".join(rng.choice(letters) for _ in range(rng.randrange(1, 25)))) for k in range(6)]
    rows = [(i, " ".join(rng.choice(letters + "XYZ") for _ in range(rng.randrange(0, 70)))) for i in range(120)]
    got = {r.doc_id: as_tuple(r) for r in li.find_licenses(spark.createDataFrame(rows, SCHEMA), templates, percent).collect()}
    assert got == {i: brute(t, templates, percent) for i, t in rows}


def test_every_notice_is_found_and_half_of_one_is_not(spark):
    rows = [(i, "Some words before. " + t + " And after.") for i, (_, t) in enumerate(li.TEMPLATES)]
    rows += [(100 + i, " ".join(t.split()[:len(t.split()) // 2])) for i, (_, t) in enumerate(li.TEMPLATES)]
    got = {r.doc_id: r for r in li.find_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, (label, _) in enumerate(li.TEMPLATES):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
        assert got[100 + i].labels == got[100 + i].base_labels


def test_one_notice_in_most_rows_and_many_in_one(spark):
    rows = [(i, "Released under the MIT License.") for i in range(900)] + [(1000, "Released under the MIT License. " * 20_000), (1001, "cc by-nc " * 3)]
    got = {r.doc_id: as_tuple(r) for r in li.find_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 902 and set(got[i] for i in range(900)) == {brute(rows[0][1])}
    assert got[1000] == (100_000, 20_000, 1, 99_996, "mit", "mit", 1.0) and got[1001] == brute(rows[-1][1])


def test_defined_cases(spark):
    docs = edge_documents(spark)
    rows = li.find_licenses(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    for i in (3, 4, 5, 6):
        assert as_tuple(by[i]) == (0, 0, None, None, "", "", 0.0)
    assert by[7].n_words == len(words(LONG)) and as_tuple(by[9]) == brute(TEXTS[8][1])
    assert li.find_licenses(empty_documents(spark)).collect() == []
    assert li.find_licenses(docs, []).count() == docs.count()
    marked = spark.createDataFrame([(1, "...under THE mit/license"), (2, "underthe mit license"), (3, "é under the mit license é"), (4, "under the mit licenseé")], SCHEMA)
    assert {r.doc_id: r.base_labels for r in li.find_licenses(marked).collect()} == {1: "mit", 2: "", 3: "mit", 4: ""}


def test_no_python_in_the_plan(spark):
    plan = li.find_licenses(spark.read.parquet(f"{SF01}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
