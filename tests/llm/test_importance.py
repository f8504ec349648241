"""Prefix CRCs against zlib, scores and ranks against a brute-force version, defined cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import LONG, TEXTS, edge_documents, empty_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm import importance as im
from shoplens.llm import textbytes as tb

SCHEMA = "doc_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def features(text):
    w = words(text)
    return w + [" ".join(p) for p in zip(w, w[1:])]


def brute(docs, target, percent=25, min_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t_ = Counter(bucket(f) for t in target for f in features(t))
    big_s, big_t = sum(s.values()), sum(t_.values())
    gain = lambda b: math.floor(1000 * math.log((t_[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    out = []
    for i, t in docs:
        f = features(t)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(t)) >= min_words))
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(order) // 100
    ranks = {}
    for n, r in enumerate(order[:drawn], 1):
        ranks.setdefault(r[0], []).append(n)
    return out, ranks


def check(spark, docs, target):
    got = im.resample(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame([(n, t) for n, t in enumerate(target)], "item_id bigint, text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = got.collect()
    out, ranks = brute(docs, target)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=key) == sorted((r[:4] for r in out), key=key)
    have = {}
    for r in got:
        if r.rank is not None:
            have.setdefault(r.doc_id, []).append(r.rank)
    assert {k: sorted(v) for k, v in have.items()} == ranks
    return got


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Z9é中\U0001f600.,\n"), max_size=60), max_size=5), st.integers(1, 4))
def test_crcs_equal_zlib(texts, n):
    raw = [t.encode() for t in texts]
    data = tb.LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    crcs = im.FeatureCrcs(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))
    expect = [zlib.crc32(" ".join(w[i:i + n]).encode()) for t in texts for w in [words(t)] for i in range(len(w) - n + 1)]
    assert crcs.ngrams(n)[1].tolist() == expect


def test_crcs_across_blocks_and_of_long_words():
    texts = ["w" * 3 * im.BLOCK + " tail " + "v" * 5000, "short", "x y " * im.BLOCK]
    raw = [t.encode() for t in texts]
    crcs = im.FeatureCrcs(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    first, got = crcs.ngrams(2)
    expect = [zlib.crc32(" ".join(w[i:i + 2]).encode()) for t in texts for w in [t.split()] for i in range(len(w) - 1)]
    assert got.tolist() == expect


def test_against_brute_force(spark):
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "MIXED", "中文"]
    rng = np.random.default_rng(5)
    docs = [(int(i), " ".join(rng.choice(vocabulary, int(rng.integers(0, 90))))) for i in range(400)]
    docs += [(500 + i, docs[3][1]) for i in range(40)]                       # copies
    got = check(spark, docs, ["w1 w2 w3 Été", "w5 MIXED", "", None])
    assert any(r.rank == 1 for r in got)


def test_repeated_rows_and_ids_get_ranks_of_their_own(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = check(spark, [(1, text)] * 200 + [(2, text), (None, text), (None, "few words")], ["w1"])
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 25 * 202 // 100 + 1))


def test_defined_cases(spark):
    docs, bench = edge_documents(spark), spark.createDataFrame([(1, "quick brown"), (None, None)], "item_id bigint, text string")
    rows = im.resample(docs, bench).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert all((by[i].n_features, by[i].weight, by[i].rank) == (0, 0, None) for i in (3, 4, 5, 6))
    assert by[7].n_features == len(features(LONG)) and by[9].n_features == len(features(TEXTS[8][1]))
    assert by[8].n_features == 1 and by[8].rank is None
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert im.resample(empty_documents(spark), bench).collect() == []
    assert len(im.resample(docs, none).collect()) == docs.count()


@pytest.mark.parametrize("count", [0, 1, 127, 128, 300_000])
def test_shift_is_zero_bytes(count):
    r = np.array([1, 0x80000000, 0x12345678], np.uint32)
    expect = r
    for _ in range(count):
        expect = im.step_zero(expect)
    assert im.shift(r, np.full(3, count)).tolist() == expect.tolist()
