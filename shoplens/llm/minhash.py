"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard check (op 10).

A document's set is its distinct shingles of some words (words: runs without ASCII
white space, A-Z lower-cased); a shorter document is one shingle.  Documents with
``100 * |A & B| >= percent * |A | B|`` are linked, and components of links are the
duplicate groups.  A ``Rule`` holds words, percent, bands and screen: ``OP10`` (3 words,
85) is the query's, ``GENERAL`` (5 words, 80) that of other uses, such as the pipeline.

Signatures are C-MinHash: one permutation ``sigma`` scatters the shingles over
[0, 2^32), the second, ``pi``, gives every coordinate ``k`` by circular shifts:
``min over shingles of pi(sigma(x) - k mod 2^32)``.  Both are bijective integer
mixers, so no permutation table is stored.

Steps, all distributed:

1. one pass over the texts: set size, set digest and signature;
2. equal sets are collapsed to their smallest id (a group of copies of any
   size costs one partially aggregated row a task);
3. each band bucket names its least id as hub; every member is screened against
   the hub by signature, checked on the full sets, and links merge components.
   A group of n near copies costs about n checks, not n^2;
4. buckets whose members are still in several components are searched in blocks
   of at most ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles: a task holds two
   blocks, compares only members of different components, first by signature,
   then on bit sets of the full shingle sets, and emits one link for each pair of
   components it joins.  Pairs are never rows, and no link is lost, whatever the
   bucket's size.

Misses: two sets at the threshold share no band with probability 4e-7
(20 bands of 4 at 85, 28 at 80), and fail the signature screen (44 of 80, 60 of 112
coordinates) with less than 1e-9; both fall fast above it.

Defined cases: null or blank text has no set (``n_shingles`` 0, own component);
rows that share a doc_id are one vertex; rows with a null doc_id link nothing
by themselves and are kept; an empty table gives no rows; other input columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import textbytes as tb
from shoplens.llm.staging import Staging, documents, keys_and_text
from shoplens.plans.joins import maybe_broadcast

ROWS = 4                # coordinates of a band
BLOCK, BLOCK_SHINGLES = 1024, 400_000


def _fmix32(x: np.ndarray, c1: int, c2: int) -> np.ndarray:
    x ^= x >> np.uint32(16)
    x *= np.uint32(c1)
    x ^= x >> np.uint32(13)
    x *= np.uint32(c2)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(column, size: int = 3):
    """For slices of an Arrow text column: (distinct shingle hashes, set sizes), in row order."""
    raw, offsets = tb.utf8_column(column)
    for a, b in tb.slices(offsets):
        data = tb.LOWER[raw[offsets[a]:offsets[b]]]
        off = offsets[a:b + 1] - offsets[a]
        starts, ends, cut = tb.spans(~tb.ASCII_SPACE[data], off)
        words = tb.span_hash(data, starts, ends)
        grams = tb.gram_hash(words, size)
        sets, sizes = [], np.zeros(b - a, np.int64)
        for i, (lo, hi) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
            n = hi - lo
            if n == 0:
                continue
            s = np.unique(grams[lo:hi - size + 1]) if n >= size else tb.gram_hash(words[lo:hi], n)
            sets.append(s)
            sizes[i] = len(s)
        yield np.concatenate(sets) if sets else np.empty(0, np.uint64), sizes


def signatures(shingles: np.ndarray, sizes: np.ndarray, coordinates: int = 80) -> np.ndarray:
    """Signature of every set (rows of ``coordinates`` uint32); an empty set has all ones."""
    out = np.full((len(sizes), coordinates), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        x = _fmix32((shingles >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)  # sigma
        first = (np.cumsum(sizes) - sizes)[full]
        for k in range(coordinates):
            shifted = x - np.uint32(k)                                # circular shift by k
            out[full, k] = np.minimum.reduceat(_fmix32(shifted, 0x85EBCA6B, 0xC2B2AE35), first)  # pi
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    s = signature.astype(np.uint64).reshape(len(signature), bands, rows)
    h = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        h = tb.mix64(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r] + np.uint64(1))
    return h


_SKETCH = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary"


def _signatures_of(column, n: int) -> np.ndarray:
    return np.frombuffer(tb.utf8_column(column)[0].tobytes(), np.uint32).reshape(n, -1)


_BLOCK_KEYS = ["band", "key", "i", "j"]


def _groups(batches):
    """Rows sorted by the four block keys -> one table a group (bounded by the block size)."""
    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table]).combine_chunks()
        if not table.num_rows:
            continue
        keys = np.stack([table.column(k).to_numpy() for k in range(len(_BLOCK_KEYS))])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield table.slice(a, b - a)
        carry = table.slice(cuts[-1])
    if carry is not None and carry.num_rows:
        yield carry


def _cross(table):
    """Members, components, blocks, and the members that need a look: those outside the largest component."""
    doc, comp, salt, n = (table.column(k).to_numpy() for k in ("doc_id", "comp", "salt", "n_shingles"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    names, number, count = np.unique(comp, return_inverse=True, return_counts=True)
    ask = np.flatnonzero(number != np.argmax(count)) if len(names) > 1 else np.empty(0, np.int64)
    return doc, comp, salt, n, i, j, ask


@dataclass(frozen=True)
class Rule:
    """When two documents are near duplicates, and the signature that finds them; its methods run in tasks."""

    words: int              # of a shingle
    percent: int            # linked: 100 * |A & B| >= percent * |A | B|
    bands: int
    screen: int             # agreeing coordinates that a pair at the threshold has (all but 1e-9)

    def sketch(self, batches):
        for batch in batches:
            done = 0
            for shingles, sizes in shingle_sets(batch.column(1), self.words):
                n = len(sizes)
                sig = signatures(shingles, sizes, self.bands * ROWS)
                ends = np.cumsum(sizes)
                digest = []
                for salt in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):
                    total = np.zeros(len(shingles) + 1, np.uint64)
                    np.cumsum(tb.mix64(shingles * np.uint64(salt)), out=total[1:])
                    digest.append(tb.as_signed(total[ends] - total[ends - sizes]))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(done, n),
                    pa.array(sizes),
                    pa.array(digest[0]), pa.array(digest[1]),
                    pa.array([s.tobytes() for s in sig], pa.binary()),
                ], names=["doc_id", "n_shingles", "d1", "d2", "sig"])
                done += n

    def band_rows(self, batches):
        """(doc_id, n_shingles, sig) -> one row a band: band, key, doc_id, n_shingles."""
        for batch in batches:
            n = batch.num_rows
            if n:
                keys = tb.as_signed(band_keys(_signatures_of(batch.column(2), n), self.bands)).ravel()
                at = pa.array(np.repeat(np.arange(n), self.bands))
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(self.bands, dtype=np.int32), n)), pa.array(keys),
                                                  batch.column(0).take(at), batch.column(1).take(at)], names=["band", "key", "doc_id", "n_shingles"])

    def linked(self, both, na, nb):
        return (both > 0) & (100 * both >= self.percent * (na + nb - both))

    def sets(self, column) -> list[np.ndarray]:
        out = []
        for shingles, sizes in shingle_sets(column, self.words):
            out += np.split(shingles, np.cumsum(sizes)[:-1])
        return out

    def check_pairs(self, batches):
        """(a, b, text_a, text_b) -> the linked (a, b): exact Jaccard on the full sets."""
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = [bool(self.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
                    for x, y in zip(self.sets(batch.column(2)), self.sets(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["a", "b"])

    def screen_pairs(self, batches):
        """(a, b, na, nb, sig_a, sig_b) -> pairs that sizes and signatures allow."""
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ok = (_signatures_of(batch.column(4), n) == _signatures_of(batch.column(5), n)).sum(axis=1) >= self.screen
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            ok &= 100 * np.minimum(na, nb) >= self.percent * np.maximum(na, nb)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], names=["a", "b"])

    def may_pair(self, x, comp, salt, n, same_block):
        """Members of other components whose size allows a link with member ``x`` (blocks differ unless the group is one)."""
        ok = (comp != comp[x]) & (100 * np.minimum(n, n[x]) >= self.percent * np.maximum(n, n[x]))
        return ok if same_block else ok & (salt != salt[x])

    def screen_blocks(self, batches):
        """Block rows with signatures -> the members with a partner that the signatures allow."""
        for table in _groups(batches):
            doc, comp, salt, n, i, j, ask = _cross(table)
            sig = _signatures_of(table.column("sig").combine_chunks(), len(doc))
            hit = np.zeros(len(doc), bool)
            for x in ask.tolist():
                at = np.flatnonzero(self.may_pair(x, comp, salt, n, i == j))
                near = at[(sig[at] == sig[x]).sum(axis=1) >= self.screen]
                if len(near):
                    hit[x] = True
                    hit[near] = True
            if hit.any():
                yield table.select([*_BLOCK_KEYS, "doc_id", "comp", "salt", "n_shingles"]).filter(pa.array(hit)).combine_chunks().to_batches()[0]

    def check_blocks(self, batches):
        """Block rows with texts -> links (a, b), one for each pair of components that a member joins."""
        for table in _groups(batches):
            doc, comp, salt, n, i, j, ask = _cross(table)
            if not len(ask):
                continue
            sets = self.sets(table.column("text"))
            _, where, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            place = np.where(df > 1, np.cumsum(df > 1) - 1, -1)[where]         # shingles of one member alone can't be common
            size = int((df > 1).sum())
            bits = np.zeros((len(sets), -(-max(size, 1) // 64) * 8), np.uint8)
            for r, own in enumerate(np.split(place, np.cumsum([len(s) for s in sets])[:-1])):
                row = np.zeros(bits.shape[1] * 8, np.uint8)
                row[own[own >= 0]] = 1
                bits[r] = np.packbits(row)
            bits = bits.view(np.uint64)
            a, b = [], []
            for x in ask.tolist():
                at = np.flatnonzero(self.may_pair(x, comp, salt, n, i == j))
                if len(at):
                    both = np.bitwise_count(bits[at] & bits[x]).sum(axis=1).astype(np.int64)
                    at = at[self.linked(both, n[at], n[x])]
                    _, one = np.unique(comp[at], return_index=True)
                    a += [doc[x]] * len(one)
                    b += doc[at[one]].tolist()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


OP10 = Rule(words=3, percent=85, bands=20, screen=44)
GENERAL = Rule(words=5, percent=80, bands=28, screen=60)


def sketches(docs: DataFrame, rule: Rule) -> DataFrame:
    """Per row: set size, 128-bit set digest and signature (one pass over the texts)."""
    return keys_and_text(docs).mapInArrow(rule.sketch, _SKETCH)


def merge_components(staging: Staging, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (doc_id, comp) after the links (a, b): smallest-label propagation with jumps.

    Works on the graph of components touched by links, written after each
    step; a step lowers every label to its neighbours' least and then follows
    it once more, so paths halve.
    """
    la, lb = labels.select(F.col("doc_id").alias("a"), F.col("comp").alias("u")), labels.select(
        F.col("doc_id").alias("b"), F.col("comp").alias("v"))
    edges = links.join(la, "a").join(lb, "b").where("u <> v").select("u", "v")
    edges = staging.save(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    state = staging.save(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("l")), "state")
    while True:
        near = edges.join(state.select(F.col("u").alias("v"), F.col("l").alias("nl")), "v").groupBy("u").agg(F.min("nl").alias("nl"))
        low = state.join(near, "u").select("u", F.least("l", "nl").alias("m"), F.col("l").alias("was"))
        jump = state.select(F.col("u").alias("m"), F.col("l").alias("jl"))
        step = low.join(jump, "m", "left").select("u", F.least("m", F.coalesce("jl", "m")).alias("l"),
                                                  (F.least("m", F.coalesce("jl", "m")) < F.col("was")).alias("moved"))
        new = staging.save(step, "state")
        moved = new.where("moved").limit(1).count()
        staging.drop(state)
        state = new.select("u", "l")
        state._staged_path = new._staged_path
        if not moved:
            break
    out = labels.join(state.withColumnRenamed("u", "comp"), "comp", "left").select(
        "doc_id", F.coalesce("l", "comp").alias("comp"))
    out = staging.save(out, "labels")
    staging.drop(edges)
    staging.drop(state)
    return out


def near_duplicates(docs: DataFrame, rule: Rule = OP10) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id (least doc_id of its group), kept."""
    spark = docs.sparkSession
    st = Staging(spark, "minhash")
    rows = st.save(sketches(docs, rule), "sketches")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    # All rows of a digest have the same signature, so any of them serves.
    reps = st.save(full.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("doc_id"), F.any_value("sig").alias("sig")), "reps")

    # Buckets with at least two members; the others can't give a pair.
    bands = reps.select("doc_id", "n_shingles", "sig").mapInArrow(rule.band_rows, "band int, key bigint, doc_id bigint, n_shingles bigint")
    bands = st.save(bands, "bands")
    shared = bands.groupBy("band", "key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("hi")).where("hub <> hi").select("band", "key", "hub")
    members = st.save(bands.join(shared, ["band", "key"]), "members")
    st.drop(bands)
    active = st.save(members.select("doc_id").distinct(), "active")
    # The texts that later steps read: those of documents in a shared bucket, written once.
    texts = keys_and_text(docs).join(maybe_broadcast(active), "doc_id", "left_semi")
    texts = st.save(texts, "texts")
    sigs = st.save(reps.select("doc_id", "n_shingles", "sig").join(maybe_broadcast(active), "doc_id", "left_semi"), "sigs")
    labels = active.select("doc_id", F.col("doc_id").alias("comp"))

    pairs = members.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    side = lambda t, k, c: t.select(F.col("doc_id").alias(k), *[F.col(x).alias(f"{x}_{k}") for x in c])
    screened = st.save(pairs.join(side(sigs, "a", ["n_shingles", "sig"]), "a").join(side(sigs, "b", ["n_shingles", "sig"]), "b").select(
        "a", "b", "n_shingles_a", "n_shingles_b", "sig_a", "sig_b").mapInArrow(rule.screen_pairs, "a bigint, b bigint"), "screened")
    checked = screened.join(side(texts, "a", ["text"]), "a").join(side(texts, "b", ["text"]), "b").select("a", "b", "text_a", "text_b")
    labels = merge_components(st, labels, st.save(checked.mapInArrow(rule.check_pairs, "a bigint, b bigint"), "links"))

    # Buckets of several components: a bucket of two has been checked whole.
    now = members.join(labels, "doc_id")
    open_ = now.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"),
                                           F.sum("n_shingles").alias("total")).where("lo <> hi and m > 2")
    blocks = F.greatest(F.ceil(F.col("total") / BLOCK_SHINGLES), F.ceil(F.col("m") / BLOCK)).cast("int")
    rows_in = now.join(open_.select("band", "key", blocks.alias("blocks")), ["band", "key"]).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    rows_in = rows_in.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "key", F.least("salt", "t").alias("i"), F.greatest("salt", "t").alias("j"), "doc_id", "comp", "salt", "n_shingles")
    in_blocks = lambda t: t.repartition(*_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS)
    plain = "band int, key bigint, i int, j int, doc_id bigint, comp bigint, salt int, n_shingles bigint"
    near = in_blocks(rows_in.join(sigs.select("doc_id", "sig"), "doc_id").select(*_BLOCK_KEYS, "doc_id", "comp", "salt", "n_shingles", "sig"))
    near = st.save(near.mapInArrow(rule.screen_blocks, plain), "near")
    whole = in_blocks(near.join(texts, "doc_id").select(*_BLOCK_KEYS, "doc_id", "comp", "salt", "n_shingles", "text"))
    more = st.save(whole.mapInArrow(rule.check_blocks, "a bigint, b bigint").distinct(), "links")
    if more.limit(1).count():
        labels = merge_components(st, labels, more)
    for t in (members, texts, sigs, near, screened):
        st.drop(t)

    comp = reps.select("n_shingles", "d1", "d2", F.col("doc_id").alias("rep")).join(
        labels.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        "n_shingles", "d1", "d2", F.coalesce("comp", "rep").alias("comp"))
    out = rows.select("doc_id", "n_shingles", "d1", "d2").join(comp, ["n_shingles", "d1", "d2"], "left")
    component = F.coalesce(F.when(F.col("n_shingles") > 0, F.col("comp")), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, rule: Rule = GENERAL) -> DataFrame:
    """The documents that are the least id of their group; all columns stay.

    Rows with a null doc_id stay; rows that repeat one doc_id are one document
    and stay or go together.
    """
    gone = near_duplicates(docs, rule).where("not kept").select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone_id"], "left_anti")


def near_duplicates_query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


# Least doc_id reachable over pairs found by counting common shingles.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept
FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""
