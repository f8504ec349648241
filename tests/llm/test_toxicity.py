import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import SF01, edge_documents, empty_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoplens.llm import toxicity

LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    rows = out.join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert len(toxic) > 50
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def brute_segments(scores):
    """All maximal-scoring segments by their definition: recursively the best segment, then both sides."""
    if not len(scores) or max(scores) <= 0:
        return []
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if best is None or s > best[2] or (s == best[2] and b - a < best[1] - best[0]):
                best = (a, b, s)
    a, b, s = best
    left = brute_segments(scores[:a])
    right = [(x + b, y + b, z) for x, y, z in brute_segments(scores[b:])]
    return left + [best] + right


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-60, 60).filter(lambda x: x), max_size=14).map(lambda x: [v + 0.001 * i for i, v in enumerate(x)]))
def test_linear_scan_finds_the_maximal_segments(scores):
    got = toxicity.maximal_segments(np.array(scores))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(scores)]


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    spoiled = labels.withColumn("toxic", F.when(toxicity.held_out(parts=5, part=0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x) for x in (labels, spoiled))
    assert np.array_equal(a.odds, b.odds, equal_nan=True) and np.array_equal(a.z, b.z, equal_nan=True)
    assert (a.at, a.decay, a.rate, a.slope, a.shift) == (b.at, b.decay, b.rate, b.slope, b.shift)


WORD = re.compile("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+")


def plain_features(word):
    """Buckets of one word, by the library's hash alone."""
    ((data, starts, ends, _, hashes),) = list(toxicity.batch_words(pa.array([word])))
    return [int(x) for x in toxicity.features(data, starts, ends, hashes)[:, 0]]


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def small_corpus():
    """300 labelled texts with graded words, copies of texts and unlabelled ones."""
    rnd = random.Random(5)
    words = [f"word{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        own = rnd.choices(words, k=rnd.randrange(0, 14)) + (rnd.choices(["Vile", "scum", "scummy", "slür"], k=rnd.randrange(1, 4)) if bad else [])
        rnd.shuffle(own)
        rows.append((i, " ".join(own) if i % 50 else None))
        labels.append((i, int(bad)))
    rows += [(1000 + i, rows[i % 7 + 1][1]) for i in range(60)] + [(2000 + i, f"vile unlabelled word{i}") for i in range(30)]
    return rows, labels


def test_scores_equal_a_plain_version(spark):
    """Counts, log-odds, z-scores, token scores, segments and calibrated scores, row by row without arrays."""
    rows, labels = small_corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))

    text, known = dict(rows), set()
    for i, y in labels:
        if zlib.crc32(str(i).encode()) % 5:
            known.add((text[i], y))
    counts = {y: Counter(f for t, own in known if own == y for f in {f for w in plain_words(t) for f in plain_features(w)}) for y in (0, 1)}
    different = {t for _, t in rows}
    corpus = Counter(f for t in different for f in {f for w in plain_words(t) for f in plain_features(w)})
    size, n_all = {y: counts[y].total() for y in (0, 1)}, corpus.total()
    for f in counts[0].keys() | counts[1].keys():
        y = {c: counts[c][f] + toxicity.PRIOR * size[c] * corpus[f] / n_all for c in (0, 1)}
        all_of = {c: (1 + toxicity.PRIOR) * size[c] for c in (0, 1)}
        odds = math.log(y[1] / (all_of[1] - y[1])) - math.log(y[0] / (all_of[0] - y[0]))
        assert math.isclose(model.odds[f], odds, rel_tol=1e-5, abs_tol=1e-5)
        assert math.isclose(model.z[f], odds / math.sqrt(1 / y[1] + 1 / y[0]), rel_tol=1e-5, abs_tol=1e-5)
    assert np.isfinite(model.odds).sum() == len(counts[0].keys() | counts[1].keys())

    def token(word):
        for f in plain_features(word):
            if model.z[f] >= model.at:
                return float(model.odds[f])
            if model.z[f] <= toxicity.CLEAN_Z:
                break
        return toxicity.DRIFT

    for r in toxicity.score(docs, model).collect():
        s = [token(w) for w in plain_words(text[r.doc_id])]
        best = max((sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=0.0)
        expected = 0.0
        if best > 0:
            x = min(toxicity.SATURATED, model.decay * best - math.log(model.rate * len(s)))
            expected = 1 / (1 + math.exp(-max(-50.0, min(50.0, model.slope * x + model.shift))))
        assert math.isclose(r.score, expected, rel_tol=1e-6, abs_tol=1e-9) and r.predicted == int(r.score >= 0.5)


def test_levels_are_judged_on_other_folds(spark):
    """A word that stands in one toxic text alone never helps a text of another fold: noise asks for a strict level."""
    rnd = random.Random(11)
    rows = [(i, " ".join(f"w{rnd.randrange(400)}" for _ in range(30)) + (" vile" if i % 5 == 0 else "")) for i in range(500)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(500)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, labels)
    vile = plain_features("vile")[0]
    assert model.z[vile] >= model.at
    noise = [plain_features(f"w{i}")[0] for i in range(400)]
    assert sum(model.z[f] >= model.at for f in noise) <= 2
    by = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert sum(by[i] != int(i % 5 == 0) for i in by) <= 5


def test_thresholds_grow_with_the_features_tested():
    a, b = toxicity.thresholds(1000), toxicity.thresholds(1_000_000)
    assert all(x < y for x, y in zip(a, b)) and a == sorted(a)
    assert toxicity.thresholds(0)[0] == toxicity.MIN_Z


def test_copies_do_not_make_their_words_toxic(spark):
    """A text copied 300 times and marked toxic is one document to learn from."""
    rows = [(i, f"calm words number{i} of the day") for i in range(300)] + [(i, "rare copied passage of the day") for i in range(300, 600)]
    docs = spark.createDataFrame(rows + [(600, "rare copied words of another day")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(600)], "doc_id bigint, toxic int")
    by = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert by[600].predicted == 0 and by[0].predicted == 0


def test_a_hot_text_does_not_hide_toxic_words(spark):
    """A third of all rows is one unlabelled text that holds every toxic word."""
    slurs = ("vile", "slur", "scum")
    rows = [(i, f"number{i} calm words all day long {slurs[i // 8 % 3] if i % 8 == 0 else 'quiet'} more calm words") for i in range(960)]
    hot = [(i, "the vile slur and scum of one hot text") for i in range(960, 1440)]
    docs = spark.createDataFrame(rows + hot, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(960)], "doc_id bigint, toxic int")
    by = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert all(by[i] == int(i % 8 == 0) for i in range(960))


def test_copies_weigh_as_one_text(spark):
    rows = [(i, f"text {i}") for i in range(20)] + [(None, "copied")] * 30 + [(7, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for most in (10, 0):
        got = toxicity.different_texts(docs, toxicity.Staging(spark, "copies-test"), most).groupBy("text").agg(F.sum("weight").alias("w")).collect()
        assert {r.text: round(r.w, 9) for r in got} == {t: 1.0 for _, t in rows}


def test_passages_are_located(spark):
    rows = [(i, f"number{i} " + ("calm words all day long " * 10) + ("vile slur vile slur " if i % 4 == 0 else "") + "more calm words é here")
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    for r in out:
        assert r.predicted == int(r.doc_id % 4 == 0)
        if r.predicted:
            a, b = map(int, r.passages.split(",")[0].split(":"))
            assert rows[r.doc_id][1][a:b] == "vile slur vile slur"


def test_defined_cases(spark):
    docs = edge_documents(spark)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len(out) == docs.count() and all(r.score == 0.0 for r in out)
    some = spark.createDataFrame([(1, 1), (9, 0), (8, 0), (2, None), (None, 1)], "doc_id bigint, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, some)).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(empty_documents(spark), toxicity.fit(empty_documents(spark), none)).collect() == []
