"""Document fingerprints: Merkle trees over paragraphs, sections and chapters (op 6).

Only DataFrame functions: no Python runs on the executors.

A text's paragraphs are its lines.  Cuts between the higher nodes are found in the
content: a section ends after a paragraph, a chapter after a section, whose hash ends
in 0 or 8, so an inserted paragraph changes its own section and chapter and no
others.  A node's hash is the SHA-256 of its children's hashes (lower ones 128 bits
of it), the root's is whole: roots are equal exactly when texts are.

A paragraph's leaves are hashes of its pieces.  A piece ends after a word that ends in
one of a few letters, 12 to 72 characters after the piece before, so that a piece
depends on the text around it and not on its place; where there is no such word it
ends after 72 characters.  Likeness is the share of common leaves.

The fingerprint is text, each node's hash behind its children:
``root={[leaves:paragraph;leaves:paragraph;...]section;[...]section;}chapter;{...}...``

Defined cases: null text is empty (one empty paragraph); rows with the same
doc_id and text are one document, each row gets its result; a null doc_id counts
as the least id (-2^63 itself is reported as null); a single document is its own
next one; an empty table gives no rows; a text of any length is read whole, in linear
time; equal ids are ordered by a hash of their text; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.staging import Staging, documents, keys_and_text

PIECE = r"(?s).{12,70}?[eoy] |.{1,72}"
HASH = 32                       # hex digits of the lower nodes
_SECTION_END = "(?<=[08];)"
_CHAPTER_END = rf"(?<=\][0-9a-f]{{{HASH - 1}}}[08];)"
_LEAST = -(1 << 63)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as the element of a one-element array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hash(children: Column) -> Column:
    return F.substring(F.sha2(children, 256), 1, HASH)


def _parts(text: Column, end: str) -> Column:
    return F.filter(F.split(text, end, -1), lambda x: x != "")


def _leaf(value: Column) -> Column:
    """A 32-bit hash as 8 hex digits."""
    return F.lpad(F.hex(value.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")


def tree(text: Column) -> Column:
    """The tree of a text: struct(root, body, leaves); ``leaves`` are all pieces' hashes in order."""
    paragraphs = F.transform(F.split(text, "\n", -1), lambda p: F.struct(
        _hash(p).alias("h"), F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda s: F.hash(s)).alias("leaves")))

    def sections_of(nodes):
        listed = F.array_join(F.transform(nodes, lambda x: F.concat(
            F.lower(F.array_join(F.transform(x["leaves"], _leaf), "")), F.lit(":"), x["h"], F.lit(";"))), "")
        return F.array_join(F.transform(_parts(listed, _SECTION_END), lambda s: F.concat(
            F.lit("["), s, F.lit("]"), _hash(F.regexp_replace(s, "[0-9a-f]*:", "")), F.lit(";"))), "")

    def chapters_of(sections):
        return F.array_join(F.transform(_parts(sections, _CHAPTER_END), lambda c: F.concat(
            F.lit("{"), c, F.lit("}"), _hash(F.regexp_replace(c, r"\[[^\]]*\]", "")), F.lit(";"))), "")

    return _bound(paragraphs, lambda nodes: _bound(chapters_of(sections_of(nodes)), lambda body: F.struct(
        F.sha2(F.regexp_replace(body, r"\{[^}]*\}", ""), 256).alias("root"), body.alias("body"),
        F.flatten(F.transform(nodes, lambda x: x["leaves"])).alias("leaves"))))


def spelled(node: Column) -> Column:
    """The fingerprint text of a ``tree``."""
    return F.concat(node["root"], F.lit("="), node["body"])


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (a column expression)."""
    return _bound(tree(text), spelled)


def root(print_: Column) -> Column:
    return F.substring_index(print_, "=", 1)


def leaves(print_: Column) -> Column:
    """The short hashes of all pieces, in order."""
    listed = F.regexp_replace(F.substring_index(print_, "=", -1), rf":[0-9a-f]{{{HASH}}};|\][0-9a-f]{{{HASH}}};|\}}[0-9a-f]{{{HASH}}};|[\[{{]", "")
    return F.regexp_extract_all(listed, F.lit("[0-9a-f]{8}"), F.lit(0))


def _near(same: Column, x: Column, y: Column) -> Column:
    def dice(p):
        both, total = F.size(F.array_intersect(p["x"], p["y"])), F.size(p["x"]) + F.size(p["y"])
        return F.when(total > 0, 2.0 * both / total).otherwise(F.lit(0.0))

    return F.when(same, F.lit(1.0)).otherwise(_bound(F.struct(F.array_distinct(x).alias("x"), F.array_distinct(y).alias("y")), dice))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints: 1 for equal roots, else the share of common pieces (Dice, as sets); 0 when neither has one."""
    return _near(root(a) == root(b), leaves(a), leaves(b))


def tree_likeness(a: Column, b: Column) -> Column:
    """``likeness`` of two trees."""
    return _near(a["root"] == b["root"], a["leaves"], b["leaves"])


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Where two fingerprints differ: numbers (from 0) of the paragraphs of ``a`` that ``b`` lacks.

    Only branches that differ are looked into: sections with a hash that the other
    side has as well are skipped whole, wherever they stand.
    """
    def sections(x):
        found = F.regexp_extract_all(x, F.lit(rf"\[[^\]]*\][0-9a-f]{{{HASH}}}"), F.lit(0))
        return F.transform(found, lambda s: F.struct(
            F.right(s, F.lit(HASH)).alias("h"), F.regexp_extract_all(s, F.lit(rf":([0-9a-f]{{{HASH}}});"), F.lit(1)).alias("p")))

    def compare(x):
        mine, theirs = F.transform(x["a"], lambda s: s["h"]), F.transform(x["b"], lambda s: s["h"])
        changed = F.array_except(mine, theirs)
        left = F.flatten(F.transform(F.filter(x["b"], lambda s: ~F.array_contains(mine, s["h"])), lambda s: s["p"]))
        places = F.flatten(F.transform(x["a"], lambda s: F.when(F.array_contains(changed, s["h"]), s["p"]).otherwise(
            F.transform(s["p"], lambda p: F.lit(None).cast("string")))))
        gone = F.array_except(F.filter(places, lambda p: p.isNotNull()), left)
        return F.filter(F.transform(places, lambda p, i: F.when(p.isNotNull() & F.array_contains(gone, p), i)), lambda i: i.isNotNull())

    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(
        _bound(F.struct(sections(a).alias("a"), sections(b).alias("b")), compare))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return keys_and_text(docs).select(F.coalesce("doc_id", F.lit(_LEAST)).alias("k"), F.xxhash64(text).alias("h"), text.alias("text"))


def next_documents(docs: DataFrame, staging: Staging) -> DataFrame:
    """Per different document its successor in descending order of id: k, h, n, copies, nk, nh.

    The ids alone are range-partitioned and written with their partition; the
    successor is found inside a partition, and the last of one continues with
    the first of the next (one row a partition).
    """
    ids = _keyed(docs).select("k", "h", F.char_length("text").cast("bigint").alias("n")).groupBy("k", "h", "n").agg(F.count(F.lit(1)).alias("copies"))
    parts = staging.save(ids.repartitionByRange(F.desc("k"), F.desc("h")).withColumn("part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("part").orderBy(F.desc("k"), F.desc("h"))
    linked = parts.withColumn("next", F.lead(F.struct("k", "h")).over(inside))
    firsts = parts.groupBy("part").agg(F.max(F.struct("k", "h")).alias("first"))
    across = Window.orderBy("part")
    begin = F.first("first").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(across), begin).alias("after"))
    out = linked.join(firsts, "part").select("k", "h", "n", "copies", F.coalesce("next", "after").alias("next"))
    return staging.save(out.select("k", "h", "n", "copies", F.col("next.k").alias("nk"), F.col("next.h").alias("nh")), "links")


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: the fingerprint, that of the edited text, and the likenesses to it and to the next document's."""
    st = Staging(docs.sparkSession, "merkle")
    links = next_documents(docs, st)
    texts = _keyed(docs)
    third = F.floor(F.col("n") / 3).cast("int")
    # A successor sends its head, its root and its leaves; no text goes along whole.
    given = texts.withColumnRenamed("k", "nk").withColumnRenamed("h", "nh").join(links, ["nk", "nh"]).select(
        "k", "h", F.left("text", third).alias("head"), _bound(tree(F.col("text")), lambda t: F.struct(t["root"], t["leaves"])).alias("after"))
    if links.where("copies > 1").limit(1).count():      # repeated rows would give their successor's part repeatedly
        given = given.dropDuplicates(["k", "h"])
    n = F.char_length("text")
    edited = F.concat(F.left("text", n - F.floor(n / 3).cast("int")), F.col("head"))
    rows = texts.join(given, ["k", "h"]).select(
        "k", n.cast("bigint").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"), tree(edited).alias("edited"), "after")
    return rows.select(F.when(F.col("k") != _LEAST, F.col("k")).alias("doc_id"), "n_chars", "edited_sha256",
                       spelled(F.col("own")).alias("fingerprint"), spelled(F.col("edited")).alias("edited_fingerprint"),
                       tree_likeness(F.col("own"), F.col("edited")).alias("near_edited"),
                       tree_likeness(F.col("own"), F.col("after")).alias("near_next"))


def fingerprint_query(spark, sf_dir: str) -> DataFrame:
    return edit_fingerprints(documents(spark, sf_dir))
