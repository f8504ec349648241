import hashlib
import random
import re

from cases import SF01, TEXTS, edge_documents, empty_documents
from pyspark.sql import functions as F

from shoplens.llm import merkle


def murmur(raw: bytes, seed=42):
    """Spark's hash of a string: Murmur3 on 4-byte words, then on each single byte left."""
    m = 0xFFFFFFFF
    rot = lambda x, r: (x << r | x >> (32 - r)) & m
    def mix(h, k):
        k = rot(k * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
        return (rot(h ^ k, 13) * 5 + 0xE6546B64) & m
    h, n = seed, len(raw)
    for i in range(0, n - n % 4, 4):
        h = mix(h, int.from_bytes(raw[i:i + 4], "little"))
    for x in raw[n - n % 4:]:
        h = mix(h, (x - 256 if x > 127 else x) & m)
    h ^= n
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def brute_leaves(text):
    return [[f"{murmur(x.encode()):08x}" for x in re.findall(merkle.PIECE, p)] for p in text.split("\n")]


def brute_print(text):
    sha = lambda x, n=32: hashlib.sha256(x.encode()).hexdigest()[:n]

    def groups(nodes):
        """nodes: (body, hash); cut after a hash that ends in 0 or 8."""
        out, own = [], []
        for node in nodes:
            own.append(node)
            if node[1][-1] in "08":
                out.append(own)
                own = []
        return out + [own] if own else out

    paragraphs = [("".join(own) + ":", sha(p)) for p, own in zip(text.split("\n"), brute_leaves(text))]
    sections = [("[" + "".join(f"{b}{h};" for b, h in g) + "]", sha("".join(h + ";" for _, h in g))) for g in groups(paragraphs)]
    chapters = [("{" + "".join(f"{b}{h};" for b, h in g) + "}", sha("".join(h + ";" for _, h in g))) for g in groups(sections)]
    return sha("".join(h + ";" for _, h in chapters), 64) + "=" + "".join(f"{b}{h};" for b, h in chapters)


def brute_likeness(a, b):
    """Of two texts."""
    if a == b:
        return 1.0
    x, y = ({i for own in brute_leaves(t) for i in own} for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    order = sorted(docs.collect(), key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in merkle.edit_fingerprints(docs).collect()}
    assert len(got) == len(order)
    for i, r in enumerate(order):
        after, g, cut = order[(i + 1) % len(order)], got[r.doc_id], len(r.text) // 3
        edited = r.text[:len(r.text) - cut] + after.text[:cut]
        assert g.n_chars == len(r.text) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert g.fingerprint == brute_print(r.text) and g.edited_fingerprint == brute_print(edited)
        if i % 20 == 0:
            assert abs(g.near_edited - brute_likeness(r.text, edited)) < 1e-12
            assert abs(g.near_next - brute_likeness(r.text, after.text)) < 1e-12
    closer = sum(g.near_edited > g.near_next for g in got.values())
    assert closer >= 0.98 * len(got)


def test_differing_paragraphs_are_located(spark):
    lines = [f"paragraph number {i} of the text" for i in range(30)]
    other = list(lines)
    other[3], other[17] = "changed", "changed too"
    df = spark.createDataFrame([("\n".join(lines), "\n".join(other)), ("a\nb", "a\nb"), ("a\nb\nc", "a"), ("", "x")], "a string, b string")
    got = df.select(merkle.differing_paragraphs(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))).alias("d")).collect()
    assert [r.d for r in got] == [[3, 17], [], [1, 2], [0]]


def words(seed, n):
    rng = random.Random(seed)
    return [rng.choice(["time", "you", "stone", "many", "river", "old", "into", "house", "went", "by"]) + str(rng.randrange(40)) * (rng.random() < 0.2) for _ in range(n)]


def test_an_inserted_paragraph_is_the_one_that_differs(spark):
    lines = [" ".join(words(i, 12)) for i in range(60)]
    rows = [("\n".join(lines[:k] + ["a new paragraph"] + lines[k:]), "\n".join(lines), k) for k in (0, 1, 30, 59, 60)]
    df = spark.createDataFrame(rows, "a string, b string, k int").select("k", merkle.fingerprint(F.col("a")).alias("a"), merkle.fingerprint(F.col("b")).alias("b"))
    for r in df.select("k", merkle.differing_paragraphs(F.col("a"), F.col("b")).alias("new"), merkle.differing_paragraphs(F.col("b"), F.col("a")).alias("lost")).collect():
        assert (r.new, r.lost) == ([r.k], [])
    # most sections and chapters are shared
    (x, y) = (re.findall(r"\]([0-9a-f]{32})", p) for p in (brute_print(rows[2][0]), brute_print(rows[2][1])))
    assert len(set(x) - set(y)) <= 2


def test_one_inserted_character_leaves_texts_alike(spark):
    text = " ".join(words(7, 600))
    rows = [(text, text[:k] + "x" + text[k:]) for k in (0, 1, 300, 1500, len(text))]
    df = spark.createDataFrame(rows, "a string, b string").select(
        merkle.likeness(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))).alias("near"),
        merkle.tree_likeness(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("same"))
    for r in df.collect():
        assert 0.9 < r.near < 1.0 and r.near == r.same


def test_defined_cases(spark):
    docs = edge_documents(spark)
    rows = merkle.edit_fingerprints(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[4].n_chars == 0 and by[4].fingerprint == by[3].fingerprint == brute_print("")
    assert by[1].fingerprint == by[2].fingerprint and by[2].near_next == 1.0
    assert by[10].edited_sha256 == hashlib.sha256((TEXTS[9][1][:-(len(TEXTS[9][1]) // 3)] + TEXTS[8][1][:len(TEXTS[9][1]) // 3]).encode()).hexdigest()
    assert None in by and by[7].n_chars == len(TEXTS[6][1])
    assert merkle.edit_fingerprints(empty_documents(spark)).collect() == []
    (one,) = merkle.edit_fingerprints(docs.where("doc_id = 9")).collect()
    assert one.near_next == 1.0


def test_no_python_in_the_plan(spark):
    plan = merkle.edit_fingerprints(edge_documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
