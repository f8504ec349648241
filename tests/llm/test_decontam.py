import hashlib
import random
import re

from cases import SF01, edge_documents, empty_documents

from shoplens.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            own = words(t)
            n = min(13, len(own))
            grams = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def fixture(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "É", "A1", "b"]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 2, 5, 12, 13, 14, 30])))) for i in range(25)] + [(25, None), (26, "of " * 40), (3, "q r s")]
    docs = []
    for i in range(120):
        own = rnd.choices(vocabulary, k=rnd.randrange(0, 90))
        for _ in range(rnd.randrange(3)):
            t = words(rnd.choice(items)[1])
            at = rnd.randrange(len(own) + 1)
            own[at:at] = t[rnd.randrange(3):]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(own).title() if i % 2 else " ".join(own)))
    return docs + [(200, None), (201, ""), (202, "of " * 500), (5, "q r s"), (5, "q r s")], items


def test_both_paths_equal_brute_force(spark):
    docs, items = fixture(3)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute(docs, items)
    assert sorted(map(tuple, decontam.contamination(d, b).collect()), key=str) == expected
    assert sorted(map(tuple, decontam.contamination(d, b, max_broadcast_windows=10).collect()), key=str) == expected


def test_filter_keeps_clean_documents_and_columns(spark):
    docs, items = fixture(4)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    clean = sorted(x[0] for x in brute(docs, items) if not x[5])
    for limit in (decontam.MAX_BROADCAST_WINDOWS, 10):
        out = decontam.drop_contaminated(d, b, limit)
        assert out.columns == d.columns and sorted(r.doc_id for r in out.collect()) == clean


def test_defined_cases(spark):
    docs = edge_documents(spark)
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
    assert decontam.contamination(docs, bench).count() == docs.count()
    nothing = bench.limit(0)
    assert not any(r.contaminated for r in decontam.contamination(docs, nothing).collect())
    assert decontam.contamination(empty_documents(spark), bench).collect() == []
    assert decontam.drop_contaminated(docs, nothing).columns == docs.columns


def test_window_minima_are_position_independent():
    import numpy as np
    rng = np.random.default_rng(0)
    w = rng.integers(0, 2**63, 100).astype(np.uint64)
    whole = decontam.window_minima(w, 13)
    assert all(decontam.window_minima(w[k:k + 13], 13)[0] == whole[k] for k in range(len(w) - 12))


def test_hot_passage_of_many_items_on_the_shuffled_path(spark):
    """A passage that most items and most documents share: one row a document and item set, same result."""
    passage = " ".join(f"w{i}" for i in range(13))
    bench = spark.createDataFrame([(i, passage + (f" own{i} words" if i % 2 else "")) for i in range(300)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"start {i} {passage} own{i} words end") for i in range(400)], "doc_id bigint, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(decontam.contamination(docs, bench, max_broadcast_windows=0)) == rows(decontam.contamination(docs, bench))


def test_windows_of_equal_hashes_are_cut_out_by_their_words(spark):
    """What the shuffled path compares behind the hash: the windows' words, at their places."""
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x y z u v"), (3, "p a b c d e q")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, "a b c d e")], "item_id bigint, text string")
    (length,) = {r["len"] for r in decontam.benchmark_windows(bench).collect()}
    keyed = docs.selectExpr("doc_id", "doc_id AS rk", "text", "transform(sequence(0, size(split(text, ' ')) - 5), i -> struct(cast(i AS bigint) AS start, 5 AS len)) AS at")
    cut = {(r.doc_id, r.start): bytes(r.text) for r in keyed.mapInArrow(decontam._cut_windows, "doc_id bigint, rk bigint, start bigint, len int, text binary").collect()}
    assert length == 5 and [k for k, v in cut.items() if v == b"a b c d e"] == [(1, 0), (3, 1)] and len(cut) == 5
