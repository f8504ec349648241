import random

import numpy as np
import pyarrow as pa
import pytest
from cases import edge_documents, empty_documents

from shoplens.llm import minhash


def brute(rows, size=3, percent=85):
    """doc_id -> (set size, component) over all pairs."""
    sets = {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        w = [x for x in low.split(" ") if x]
        sets[i] = {tuple(w)} if 0 < len(w) < size else {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
    comp = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    return {i: (len(sets[i]), comp[i]) for i in sets}


def near_rows(seed, groups=6, size=25, words=120):
    rnd = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            own = list(base)
            for _ in range(rnd.choice([0, 1, 2, 3, 4, 6, 10])):
                own[rnd.randrange(words)] = f"e{rnd.randrange(200)}"
            rows.append((i, " ".join(own)))
            i += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [1024, 4])
def test_components_equal_brute_force(spark, monkeypatch, block):
    """Also with blocks so small that every open bucket is searched in many of them."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows(5)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [1024, 4])
def test_the_general_rule_equals_brute_force(spark, monkeypatch, block):
    """Five words and 0.8: scattered edits, and whole passages added or cut."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows(6, words=150)
    rnd = random.Random(2)
    for i in range(1000, 1080):
        base = rows[rnd.randrange(150)][1].split()
        cut = rnd.randrange(0, 45)
        at = rnd.randrange(len(base) - cut)
        rows.append((i, " ".join(base[:at] + base[at + cut:] if i % 2 else base[:at] + [f"n{i}x{k}" for k in range(cut)] + base[at:])))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), minhash.GENERAL).collect()
    expect = brute(rows, 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expect
    assert expect != {i: (n, c) for i, (n, c) in brute(rows).items()}


def test_a_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(100 - k, " ".join(words[4 * k:4 * k + 120])) for k in range(20)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert len({r.component_id for r in got}) == 1


def test_large_group_of_copies(spark):
    rows = [(i, "the same text over and over again in every row") for i in range(3000, 0, -1)] + [(0, "another text that is alone here")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect()
    assert {r.component_id for r in got if r.doc_id} == {1} and sum(r.kept for r in got) == 2


def test_defined_cases(spark):
    docs = edge_documents(spark)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == 1 and not by[2].kept and by[1].kept
    assert all(by[i].n_shingles == 0 and by[i].kept for i in (3, 4, 5))
    assert by[None].kept and by[None].component_id is None
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert 2 not in {r.doc_id for r in kept.collect()}
    assert minhash.near_duplicates(empty_documents(spark)).collect() == []


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    sig = minhash.signatures(np.concatenate([a, b]), np.array([1000, 1000]), 512)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.08


def test_short_documents_are_one_shingle():
    (sets, sizes), = minhash.shingle_sets(pa.array(["a b", "a  B", "b a", "a", None, " "]))
    assert sizes.tolist() == [1, 1, 1, 1, 0, 0]
    assert sets[0] == sets[1] and len(set(sets.tolist())) == 3
