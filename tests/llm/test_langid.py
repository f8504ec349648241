import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import SF01, edge_documents, empty_documents

from shoplens.llm import charngrams, langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    held = [(r.lang, got[r.doc_id]) for r in docs.collect() if got[r.doc_id].held_out]
    assert len(held) > 150
    assert sum(lang == r.lang_pred for lang, r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(300)
    spoiled = docs.withColumn("lang", langid.F.when(langid.held_out(), "xx").otherwise(langid.F.col("lang")))
    a, b = (sorted(map(tuple, langid.predict(docs, langid.fit(d)).collect())) for d in (docs, spoiled))
    assert a == b


def plain_grams(text):
    """Bucket -> count of the 1- to 3-grams of a text, code point by code point; None without a letter."""
    out = ""
    for c in text or "":
        low = c.lower() if c.isalpha() else " "
        low = low if len(low) == 1 else c
        if low != " " or not out.endswith(" "):
            out += low
    if not out.strip(" "):
        return None
    grams = Counter()
    for n in (1, 2, 3):
        for i in range(len(out) - n + 1):
            h = n
            for c in out[i:i + n]:
                h = (h + ord(c)) * 0x9E3779B1 % 2**32
                h ^= h >> 15
            grams[h % langid.BUCKETS] += 1
    return grams


def test_predictions_equal_a_plain_version(spark):
    """Document frequencies, TF-IDF, probabilities and winners, recomputed without arrays."""
    table = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang").limit(250).collect()
    extra = [(9_000_001, None, "en"), (9_000_002, "123 !", "en"), (9_000_003, "É İ ß 中文 \U0001f600 naïve", None), (None, "word", "en")]
    rows = [tuple(r) for r in table] + extra
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = langid.fit(docs)
    grams = [plain_grams(t) for _, t, _ in rows]
    learn = [g for (i, _, lang), g in zip(rows, grams) if g and i is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    df = Counter(b for g in learn for b in g)
    assert np.allclose(model.idf, [math.log((1 + len(learn)) / (1 + df[b])) + 1 for b in range(langid.BUCKETS)], rtol=1e-12)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for (i, _, _), g in zip(rows, grams):
        if g is None:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        x = {b: (1 + math.log(c)) * model.idf[b] for b, c in g.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        logits = [sum(w[b] * v for b, v in x.items()) / norm / model.t for w in model.weights]
        p = [math.exp(v - max(logits)) for v in logits]
        best = p.index(max(p))
        assert got[i].lang_pred == model.langs[best] and math.isclose(got[i].score, p[best] / sum(p), rel_tol=1e-9)


def test_copies_of_a_row_are_learned_from_once(spark):
    """A third of all rows is one row: the model is that of the rows without its copies, but for document frequencies."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang").limit(200)
    hot = docs.where(~langid.held_out()).orderBy("doc_id").limit(1)
    copies = hot.withColumn("i", langid.F.expr("explode(sequence(1, 100))")).drop("i").union(docs).repartition(5)
    model = langid.fit(copies, sample_per_lang=50)
    again = langid.fit(copies.repartition(2), sample_per_lang=50)
    assert np.array_equal(model.weights, again.weights) and model.t == again.t
    rows = langid.predict(copies, model).collect()
    assert len(rows) == docs.count() + 100
    assert len({(r.doc_id, r.lang_pred, r.score) for r in rows}) == docs.count()


def test_defined_cases(spark):
    docs = edge_documents(spark)
    got = langid.predict(docs, langid.fit(docs)).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0.0 for i in (3, 4, 5, 6))
    assert by[None].held_out is False and by[9].lang_pred == "en"
    nothing = langid.fit(empty_documents(spark))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(empty_documents(spark), nothing).collect() == []
    kept = langid.keep_identified(docs, langid.fit(docs))
    assert kept.columns == docs.columns and not {3, 4, 5, 6} & {r.doc_id for r in kept.collect()}


def test_grams_of_a_row_do_not_depend_on_its_neighbours():
    texts = ["Hello, wörld 12", "", "abc", None, "12 !", "É \U0001f600 é"]
    together = list(charngrams.gram_counts(pa.array(texts), 512))
    for t, g in zip(texts, together):
        (own,) = charngrams.gram_counts(pa.array([t], pa.string()), 512)
        assert (own is None) == (g is None)
        if own:
            assert own[0].tolist() == g[0].tolist() and own[1].tolist() == g[1].tolist()
    assert together[1] is None and together[4] is None


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    model = langid.FtrlSoftmax(3, 50)
    for _ in range(600):
        y = int(rng.integers(3))
        at = np.sort(rng.choice(np.arange(3, 50), 5, replace=False))
        model.learn(np.append(y, at), np.full(6, 0.4), y)
    w = model.weights()
    assert (np.argmax(w[:, :3], axis=0) == [0, 1, 2]).all() and (w == 0).any()


def test_temperature_softens_overconfident_logits():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    logits = np.zeros((400, 2))
    logits[np.arange(400), np.where(rng.random(400) < 0.8, y, 1 - y)] = 20.0
    assert langid.temperature(logits, y) > 5
