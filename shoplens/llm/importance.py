"""Target-distribution importance resampling over prefix CRCs (op 11).

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z; a
text's features are its words and its pairs of neighbours joined by one space,
repeats counted.  A feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS``.

Prefix CRCs: a text is normalised to its words with one space between, and that
stream is scanned once, keeping the CRC register after each word.  A CRC is
linear over GF(2): the register of ``norm[s:e]`` is that after ``e`` with the one
after ``s``, shifted by ``e - s`` zero bytes, cancelled out of it.  So the CRC of
any n-gram comes from two kept registers and one shift, whatever its length.

The scan is vectorised: with ``A`` the step over a zero byte, the register after
``n`` bytes is ``A^n`` applied to the running XOR of ``A^-i`` of byte ``i``.  Blocks
are short, so the powers fit a cache; shifts by any count go through tables of the
powers of ``A`` to base 128.

Resampling: bucket counts of the documents and of the target text give a gain a
bucket; a document's weight is the floored mean of the gains of its features, its
score adds Gumbel noise of its id.  The greatest scores are a sample without
replacement by importance; ranks come from a range partition, never one task.

Defined cases: null or word-less text has no features, weight 0 and no rank (as
any text under ``min_words`` words); an empty target or table gives gains of the
added counts alone; a null doc_id is the text "" in the noise and comes after all
ids among ties; repeated rows are documents of their own, with ranks of their own;
a text of any length is scanned whole; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm import textbytes as tb
from shoplens.llm.staging import Staging, documents, keys_and_text
from shoplens.session import ship_package

BUCKETS = 10_000
NGRAM = 2
SEED = 7
PERCENT = 25
MIN_WORDS = 20

# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
_DIGIT = 128                    # base of the shift tables
BLOCK = _DIGIT * (_DIGIT - 1)   # bytes scanned at a time: two digits hold any place in a block


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """The register after each single byte: eight steps of the polynomial division."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = (r >> np.uint32(1)) ^ np.where(r & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return r


def step_zero(r: np.ndarray) -> np.ndarray:
    """``A``: registers after one more zero byte."""
    return (r >> np.uint32(8)) ^ byte_table()[r & np.uint32(255)]


def _apply(table: np.ndarray, digit: np.ndarray, r: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    return (table[digit, 0, r & low] ^ table[digit, 1, (r >> np.uint32(8)) & low]
            ^ table[digit, 2, (r >> np.uint32(16)) & low] ^ table[digit, 3, r >> np.uint32(24)])


@lru_cache(maxsize=8)
def shift_table(level: int) -> np.ndarray:
    """``A^(k * 128^level)`` for k below 128, by the four bytes of a register."""
    out = np.empty((_DIGIT, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    for k in range(1, _DIGIT):
        if level == 0:
            out[k] = step_zero(out[k - 1])
        else:
            last = shift_table(level - 1)           # A^128^level = A^(127 * 128^(level-1)) after A^(128^(level-1))
            out[k] = _apply(last, np.int64(1), _apply(last, np.int64(_DIGIT - 1), out[k - 1]))
    return out


def shift(r: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Registers after ``count`` more zero bytes each."""
    rest, level = np.asarray(count, np.int64), 0
    while len(rest) and rest.any():
        r = _apply(shift_table(level), rest % _DIGIT, r)
        rest, level = rest // _DIGIT, level + 1
    return r


@lru_cache(maxsize=1)
def _inverse_powers() -> np.ndarray:
    """Row t, place i: ``A^-i`` of bit t of a byte, for the places of a block."""
    out, r = np.empty(8 * BLOCK, np.uint32), 1
    for n in range(8 * BLOCK):
        out[n] = r
        r = ((r ^ POLYNOMIAL) << 1 | 1) if r >> 31 else r << 1      # one bit step back
    return np.ascontiguousarray(out.reshape(BLOCK, 8).T)


def running_registers(norm: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The register (begun at 0) after ``norm[:n]`` for each n of the rising positions ``at``: one scan."""
    powers, out, base = _inverse_powers(), np.empty(len(at), np.uint32), np.zeros(1, np.uint32)
    cuts = np.searchsorted(at, np.arange(0, norm.size + BLOCK, BLOCK), "right")
    out[:cuts[0]] = 0
    for b, first in enumerate(range(0, norm.size, BLOCK)):
        block = norm[first:first + BLOCK]
        terms = np.zeros(block.size, np.uint32)
        for t in range(8):
            terms ^= powers[t, :block.size] & -((block >> np.uint8(t)) & np.uint8(1)).astype(np.uint32)
        np.bitwise_xor.accumulate(terms, out=terms)
        mine = slice(cuts[b], cuts[b + 1])
        place = at[mine] - first
        out[mine] = shift(base ^ terms[place - 1], place)
        base = shift(base ^ terms[-1:], np.array([block.size]))
    return out


class FeatureCrcs:
    """CRCs of the n-grams of the words of some texts, from one scan of their normalised stream."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        mask = tb.ALNUM_WORD[data]
        starts, ends, self.cut = tb.spans(mask, off)      # words before each text
        length = ends - starts
        self.end = np.cumsum(length + 1) - 1
        self.start = self.end - length
        norm = np.full(int(self.end[-1]) + 1 if len(length) else 0, 32, np.uint8)
        norm[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = data[mask]
        self.at_end = running_registers(norm, self.end)
        # One space stands between a word's end and the next word.
        self.at_start = np.zeros(len(length), np.uint32)
        self.at_start[1:] = step_zero(self.at_end[:-1] ^ np.uint32(32))

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, CRC-32) of each run of ``n`` words that lies in one text."""
        words = len(self.end)
        room = np.repeat(self.cut[1:], np.diff(self.cut)) - np.arange(words)
        first = np.flatnonzero(room >= n)
        last = first + n - 1
        size = self.end[last] - self.start[first]
        return first, self.at_end[last] ^ shift(self.at_start[first] ^ _ONES, size) ^ _ONES


def _texts(column):
    raw, offsets = tb.utf8_column(column)
    for a, b in tb.slices(offsets):
        yield a, b, FeatureCrcs(tb.LOWER[raw[offsets[a]:offsets[b]]], offsets[a:b + 1] - offsets[a])


def _count_buckets(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, crcs in _texts(batch.column(0)):
            for n in range(1, NGRAM + 1):
                total += np.bincount(crcs.ngrams(n)[1] % np.uint32(BUCKETS), minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket, n over all features of the column ``text``: at most ``BUCKETS`` rows a task, then summed."""
    ship_package(texts.sparkSession)
    parts = texts.select(texts["text"].cast("string").alias("text")).mapInArrow(_count_buckets, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts(texts: DataFrame) -> list[int]:
    out = [0] * BUCKETS
    for r in bucket_counts(texts).collect():        # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """Per bucket the floored 1000-fold log ratio of smoothed shares in the target and the source."""
    s_all, t_all = sum(source), sum(target)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + float(BUCKETS)) / ((s + 1.0) * (t_all + float(BUCKETS)))))
                     for s, t in zip(source, target)], np.int64)


def noise(doc_id, seed: int = SEED) -> int:
    """Floored 1000-fold Gumbel noise from the hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigher(gain: np.ndarray, seed: int):
    def run(batches):
        for batch in batches:
            words, weights = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            count = np.zeros(batch.num_rows, np.int64)
            for a, b, crcs in _texts(batch.column(1)):
                words[a:b] = np.diff(crcs.cut)
                total = np.zeros(len(crcs.end) + 1, np.int64)
                each = np.zeros(len(crcs.end) + 1, np.int64)
                for n in range(1, NGRAM + 1):
                    first, crc = crcs.ngrams(n)
                    total[first + 1] += gain[crc % np.uint32(BUCKETS)]
                    each[first + 1] += 1
                total, each = np.cumsum(total), np.cumsum(each)
                count[a:b] = each[crcs.cut[1:]] - each[crcs.cut[:-1]]
                weights[a:b] = (total[crcs.cut[1:]] - total[crcs.cut[:-1]]) // np.maximum(count[a:b], 1)
            drawn = np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(count), pa.array(weights), pa.array(weights + drawn)],
                names=["doc_id", "n_words", "n_features", "weight", "score"])
    return run


def importance(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document doc_id, n_words, n_features, weight and score towards the texts of ``target``.

    Two passes over the documents: bucket counts, then scores.  Only the counts of
    ``BUCKETS`` buckets meet on the driver.
    """
    gain = gains(_counts(docs), _counts(target))
    return keys_and_text(docs).mapInArrow(_weigher(gain, seed), "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def rank_by_score(scored: DataFrame, staging: Staging, eligible, drawn: int) -> DataFrame:
    """``scored`` with ``rank`` 1, 2, 3... of the ``drawn`` greatest scores among the ``eligible`` rows.

    Rows are range-partitioned by score and id and written; a row's rank is its
    number inside its partition plus the eligible rows of the partitions before it
    (one row a partition).  ``rid`` parts equal rows, so no key is too hot to split.
    """
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("rid")]
    rows = scored.withColumn("eligible", F.coalesce(eligible, F.lit(False)))
    parts = staging.save(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("part").agg(F.count_if("eligible").alias("n"))
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("offset")
    ranked = parts.join(F.broadcast(sizes), "part").withColumn("place", place)          # one row a partition
    return ranked.withColumn("rank", F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place")).cast("bigint"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank: null, or its place among the drawn ones.

    Of the N documents with at least ``min_words`` words ``floor(percent * N / 100)`` are drawn.
    """
    st = Staging(docs.sparkSession, "importance")
    scored = st.save(importance(docs, target, seed).withColumn("rid", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= min_words
    drawn = percent * scored.where(enough).count() // 100
    out = rank_by_score(scored, st, enough, drawn)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def importance_query(spark, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


# A feature's CRC as the XOR of what each of its bytes contributes at its distance
# from the end; table c is grown by one zero byte a row.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
l AS MATERIALIZED (SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM w),
g AS MATERIALIZED (
  SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM l),
d AS MATERIALIZED (SELECT f, hex(encode(f)) AS x, octet_length(encode(f)) AS n FROM (SELECT DISTINCT f FROM g)),
bits AS (
  SELECT CAST(b AS BIGINT) AS b, CAST(b AS BIGINT) AS r, 0 AS i FROM range(256) t(b)
  UNION ALL
  SELECT b, xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END), i + 1 FROM bits WHERE i < 8),
tab AS MATERIALIZED (SELECT b, r FROM bits WHERE i = 8),
c AS (
  SELECT b, r, 0 AS k FROM tab
  UNION ALL
  SELECT c.b, xor(c.r >> 8, tab.r), k + 1 FROM c JOIN tab ON tab.b = c.r & 255 WHERE k < (SELECT max(n) FROM d)),
ones AS (
  SELECT CAST(4294967295 AS BIGINT) AS r, 0 AS k
  UNION ALL
  SELECT xor(ones.r >> 8, tab.r), k + 1 FROM ones JOIN tab ON tab.b = ones.r & 255 WHERE k < (SELECT max(n) FROM d)),
b AS (
  SELECT f, n, n - 1 - p AS k, 16 * (instr('0123456789ABCDEF', substr(x, 2 * p + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(x, 2 * p + 2, 1)) - 1 AS b
  FROM (SELECT f, x, n, unnest(range(0, n)) AS p FROM d)),
crc AS (SELECT f, n, bit_xor(c.r) AS r FROM b JOIN c USING (k, b) GROUP BY f, n),
h AS MATERIALIZED (SELECT f, xor(xor(crc.r, ones.r), 4294967295) % 10000 AS bucket FROM crc JOIN ones ON ones.k = crc.n),
s AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM g JOIN h USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM s) + 10000)::DOUBLE)))::BIGINT AS gain FROM s),
m AS (
  SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM g JOIN h USING (f) JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY id),
z AS (
  SELECT id, len(w) AS n_words, list_reduce(list_transform(range(1, 9), lambda i: instr('0123456789abcdef', substr(sha256('7:' || id::VARCHAR), i, 1)) - 1),
    lambda a, v: a * 16 + v)::DOUBLE AS h FROM l WHERE kind = 'd'),
r AS (
  SELECT z.id AS doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score
  FROM z LEFT JOIN m USING (id)),
p AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM r WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 25 * count(*) // 100 FROM p) THEN place END AS rank
FROM r LEFT JOIN p USING (doc_id)
"""
