"""Vector code compression with a GNAT over the codebook entries (op 12).

Components become integers ``floor(1024 * x)``; a vector is cut into ``PARTS`` equal
parts, and each part is replaced by the index of its nearest codebook entry.  The
codebooks begin with the parts of the first vectors and are trained in rounds: all
parts are assigned, then each entry becomes the floored mean of its parts.

Nearest entries are found with a geometric near-neighbour access tree (GNAT) over a
part's entries.  A node has split points; every other entry of the node goes to the
child of its nearest split point, and for each split point and child the node keeps
the range of distances from the split point to the child's entries.  A batch of
queries goes down the tree at once: a child is left out for a query whose distance
from any split point, give or take its best distance so far, misses the child's
range.  The comparison is strict and allows for the rounding of every square root,
so an entry at the same distance is never lost; best distances and ties (lower
index) are decided on the integer squares.

A pass over the vectors is one scan without a shuffle of vectors: a task ships the
sums of its parts by entry (at most parts x entries x components numbers).  Only
codebooks, whose size is fixed, meet on the driver.

Defined cases: rows whose vector is null, empty or holds a null or non-finite
component are dropped, and so are those of another length than the kept vector of
least vec_id; a length that is no multiple of ``PARTS`` is filled up with zeros;
integers beyond 2^26 either way count as that bound (squares stay in 64 bits); a null
vec_id comes after all others, equal ids are ordered by their vectors; fewer vectors
than entries give smaller codebooks; repeated rows get a row each; null labels are
one label; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.staging import Staging
from shoplens.plans.joins import broadcast_rows
from shoplens.session import ship_package

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
BOUND = 1 << 26
DEGREE, LEAF = 8, 12            # split points of a node; entries up to which a node is a leaf
SLACK = 2.0 ** -49              # of the distances summed: above the rounding of their square roots
_FAR = np.iinfo(np.int64).max


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer squared distances of all rows of ``a`` to all of ``b``."""
    most = 2 * max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if a.shape[1] * most * most < 1 << 52:          # every intermediate value is exact in a double
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


class Gnat:
    """A tree over the rows of ``points``; ``own`` numbers are the rows' indexes."""

    def __init__(self, points: np.ndarray, own: np.ndarray | None = None):
        own = np.arange(len(points)) if own is None else own
        self.children: list[Gnat | None] = []
        if len(own) <= max(LEAF, DEGREE):
            self.own, self.points = own, points[own]
            return
        between = squared_distances(points[own], points[own])
        picks = [0]                                  # farthest first, from the lowest index
        nearest = between[0].copy()
        while len(picks) < DEGREE:
            picks.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, between[picks[-1]])
        picks = sorted(set(picks))
        self.own, self.points = own[picks], points[own[picks]]
        rest = np.setdiff1d(np.arange(len(own)), picks)
        to = between[np.ix_(rest, picks)]
        home = to.argmin(1)
        self.low = np.zeros((len(picks), len(picks)))
        self.high = np.zeros((len(picks), len(picks)))
        for j in range(len(picks)):
            mine = home == j
            if not mine.any():
                self.children.append(None)
                continue
            self.low[:, j], self.high[:, j] = np.sqrt(to[mine].min(0)), np.sqrt(to[mine].max(0))
            # Equal points end up in one child: it can't get smaller, so it is a leaf.
            same = len(rest[mine]) == len(own) - len(picks) and len(picks) == 1
            self.children.append(_leaf(points, own[rest[mine]]) if same else Gnat(points, own[rest[mine]]))

    def search(self, queries: np.ndarray, who: np.ndarray, best: np.ndarray, index: np.ndarray) -> int:
        """Better the best squared distances and entries of the queries numbered ``who``; counts distances taken."""
        square = squared_distances(queries[who], self.points)
        at = square.argmin(1)                        # the first, i.e. lowest, of equal ones
        d, e = square[np.arange(len(who)), at], self.own[at]
        better = (d < best[who]) | ((d == best[who]) & (e < index[who]))
        best[who[better]], index[who[better]] = d[better], e[better]
        seen = square.size
        if any(c is not None for c in self.children):
            away = np.sqrt(square)
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                radius = np.sqrt(best[who])[:, None]
                low, high = self.low[:, j], self.high[:, j]
                slack = SLACK * (away + radius + high)
                out = ((away - radius - high > slack) | (low - away - radius > slack)).any(1)
                if not out.all():
                    seen += child.search(queries, who[~out], best, index)
        return seen


def _leaf(points: np.ndarray, own: np.ndarray) -> Gnat:
    node = Gnat.__new__(Gnat)
    node.children, node.own, node.points = [], own, points[own]
    return node


class Codebooks:
    """The entries of each part (arrays of shape entries x components) and their trees."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries
        self.trees = [Gnat(e) for e in entries]
        self.taken = 0                               # distances computed so far, for tests and tuning

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def part(self, vectors: np.ndarray, p: int) -> np.ndarray:
        return vectors[:, p * self.width:(p + 1) * self.width]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry indexes, squared distances), both of shape vectors x parts."""
        n = len(vectors)
        codes, errors = np.zeros((n, len(self.trees)), np.int64), np.zeros((n, len(self.trees)), np.int64)
        for p, tree in enumerate(self.trees):
            best, index = np.full(n, _FAR), np.full(n, _FAR)
            if n:
                self.taken += tree.search(self.part(vectors, p), np.arange(n), best, index)
            codes[:, p], errors[:, p] = index, best
        return codes, errors

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def to_integers(x: np.ndarray, width: int) -> np.ndarray:
    """``floor(1024 * x)`` within the bound, filled up with zeros to ``width`` components."""
    out = np.zeros((len(x), width), np.int64)
    out[:, :x.shape[1]] = np.clip(np.floor(SCALE * x), -BOUND, BOUND)
    return out


def _read(column, length: int, width: int):
    """(rows, integer vectors) of the vectors of a batch that are whole, finite and of that length."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    rows = np.flatnonzero((np.diff(offsets) == length) & ~column.is_null().to_numpy(zero_copy_only=False))
    x = values[offsets[rows][:, None] + np.arange(length)].astype(np.float64, copy=False)    # a null reads as NaN
    whole = np.isfinite(x).all(1)
    return rows[whole], to_integers(x[whole], width)


def _summer(books: Codebooks, length: int):
    def run(batches):
        parts, width = len(books.entries), books.width
        sums = [np.zeros((len(e), width), np.int64) for e in books.entries]
        counts = [np.zeros(len(e), np.int64) for e in books.entries]
        for batch in batches:
            _, vectors = _read(batch.column(0), length, parts * width)
            codes, _ = books.assign(vectors)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], books.part(vectors, p))
                counts[p] += np.bincount(codes[:, p], minlength=len(counts[p]))
        for p in range(parts):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used, pa.int32()), pa.array(counts[p][used]),
                 pa.array(list(sums[p][used]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])
    return run


def _numbers(vectors: DataFrame):
    ship_package(vectors.sparkSession)
    return vectors["embedding"].cast("array<double>").alias("embedding")


def first_vectors(vectors: DataFrame, entries: int) -> list[list[float]]:
    """The kept vectors of the least ids, all of one length: at most ``entries`` rows."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = vectors.select(vectors["vec_id"].cast("bigint").alias("vec_id"), _numbers(vectors)).where((F.size(e) > 0) & finite)
    order = [F.asc_nulls_last("vec_id"), F.asc("embedding")]
    first = [r["embedding"] for r in kept.orderBy(*order).limit(entries).collect()]
    if first and any(len(x) != len(first[0]) for x in first):
        same = kept.where(F.size(e) == len(first[0]))
        first = [r["embedding"] for r in same.orderBy(*order).limit(entries).collect()]
    return first


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, int] | None:
    """(codebooks, vector length) after the rounds; None without a kept vector."""
    first = first_vectors(vectors, entries)
    if not first:
        return None
    length = len(first[0])
    width = -(-length // parts)
    start = to_integers(np.array(first), parts * width)
    books = Codebooks([start[:, p * width:(p + 1) * width] for p in range(parts)])
    for _ in range(rounds):
        sums = vectors.select(_numbers(vectors)).mapInArrow(_summer(books, length), "part int, entry int, n bigint, sums array<bigint>")
        each = sums.select("part", "entry", "n", F.posexplode("sums").alias("pos", "x"))
        total = each.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        new = [e.copy() for e in books.entries]
        for r in total.collect():                    # at most parts x entries x width rows
            new[r["part"]][r["entry"], r["pos"]] = r["x"] // r["n"]
        books = Codebooks(new)
    return books, length


def _encoder(books: Codebooks, length: int):
    def run(batches):
        for batch in batches:
            rows, vectors = _read(batch.column(2), length, len(books.entries) * books.width)
            codes, errors = books.assign(vectors)
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(text, pa.string()), pa.array(errors.sum(1))],
                names=["vec_id", "label", "code", "error"])
    return run


def encode(vectors: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of each kept vector."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", vectors.schema["label"].dataType),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    rows = vectors.select(vectors["vec_id"].cast("bigint").alias("vec_id"), vectors["label"].alias("label"), _numbers(vectors))
    return rows.mapInArrow(_encoder(books, length), schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector vec_id, code, error, label_error (error over its label) and the digest of the codebooks."""
    st = Staging(vectors.sparkSession, "codes")
    model = train(vectors, parts, entries, rounds)
    if model is None:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    books, length = model
    coded = st.save(encode(vectors, books, length), "codes")
    labels = st.save(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "labels")
    labels = broadcast_rows(labels, labels.count())
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def vector_codes_query(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, part, min(d * {entries} + entry) AS v FROM (
    SELECT vec_id, part, entry, sum((x - y) * (x - y)) AS d FROM p JOIN e{r} USING (part, pos) GROUP BY vec_id, part, entry) GROUP BY vec_id, part)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT part, v % {entries} AS entry, pos, floor(sum(x)::DOUBLE / count(*))::BIGINT AS y
  FROM a{r} JOIN p USING (vec_id, part) GROUP BY part, v % {entries}, pos),
e{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(m{r}.y, e{r}.y) AS y FROM e{r} LEFT JOIN m{r} USING (part, entry, pos))""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, embedding AS x, len(embedding) // {parts} AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, i // width AS part, i % width AS pos, floor(1024 * x[i + 1]::DOUBLE)::BIGINT AS x
  FROM (SELECT vec_id, x, width, unnest(range(len(x))) AS i FROM k)),
e0 AS MATERIALIZED (
  SELECT part, entry, pos, x AS y FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k) USING (vec_id)
  WHERE entry < {entries}),{",".join(steps)},
f AS (
  SELECT vec_id, string_agg(printf('%02x', (v % {entries})::INT), '' ORDER BY part) AS code, sum(v // {entries})::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM e{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM f JOIN k USING (vec_id), h
"""


ORACLE = _oracle()
