"""Benchmark decontamination by winnowing (op 2).

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z.
A window is 13 consecutive words of a benchmark item, or the whole item when it
has fewer.  A document word inside any occurrence of a window is hit.

Winnowing: of the k-grams in each window (k = 7 of 13 words) only the one with
the least hash is kept.  The choice depends on the window alone, so a window
that occurs in both texts keeps the same fingerprint in both: every shared span
of a window's length is found.  Fingerprints of documents and benchmark are
joined, and each hit is extended to the whole windows that chose it, which are
compared in full.

The benchmark side is counted first.  Up to ``max_broadcast_windows`` windows
it is broadcast and the join happens inside one pass over the documents, with
no shuffle; beyond that fingerprints and windows are joined by shuffle, and the
windows whose hash is met are cut out and compared word for word there as well.

Defined cases: null or word-less text has no words and is not contaminated; an
item without words has no window; an empty benchmark contaminates nothing;
repeated rows give a result row each; items that share an item_id count once, a
null item_id is the text "".  Other input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import textbytes as tb
from shoplens.llm.staging import Staging, documents, keys_and_text
from shoplens.session import ship_package

WINDOW = 13
MAX_BROADCAST_WINDOWS = 200_000     # about 30 MB of window texts and hashes
MIN_SHARE = 20                      # contaminated: MIN_SHARE * n_hit >= n_words


def gram_size(length: int) -> int:
    return (length + 1) // 2


def window_minima(words: np.ndarray, length: int) -> np.ndarray:
    """Least k-gram hash of each window of ``length`` words (its fingerprint)."""
    k = gram_size(length)
    grams, w = tb.gram_hash(words, k), length - k + 1
    low, have = grams, 1
    while have < w and len(low):                 # sliding minimum by doubling
        step = min(have, w - have)
        low = np.minimum(low[:len(low) - step], low[step:])
        have += step
    return low


def batch_words(column):
    """For slices of a text column: (bytes, word starts, word ends, words before each row, word hashes)."""
    raw, offsets = tb.utf8_column(column)
    for a, b in tb.slices(offsets):
        data = tb.LOWER[raw[offsets[a]:offsets[b]]]
        starts, ends, cut = tb.spans(tb.ALNUM_WORD[data], offsets[a:b + 1] - offsets[a])
        yield data, starts, ends, cut, tb.span_hash(data, starts, ends)


def window_starts(cut: np.ndarray, length: int) -> np.ndarray:
    """True for each word at which a window of ``length`` words fits into its row."""
    n = int(cut[-1])
    room = np.repeat(cut[1:], np.diff(cut)) - np.arange(n)
    return room >= length


def full_hash(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    out = np.full(len(at), length, np.uint64)
    for j in range(length):
        out = tb.mix64(out + words[at + j])
    return out


_BENCH = "item_id string, len int, fp bigint, wh bigint, text binary"


def _bench_windows(batches):
    for batch in batches:
        row = 0
        for data, starts, ends, cut, words in batch_words(batch.column(1)):
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if hi > lo:
                    length = min(WINDOW, hi - lo)
                    own = words[lo:hi]
                    at = np.arange(len(own) - length + 1)
                    texts = [b" ".join(data[starts[i]:ends[i]].tobytes() for i in range(lo + s, lo + s + length)) for s in at.tolist()]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column(0)[row].as_py()] * len(at), pa.string()),
                        pa.array(np.full(len(at), length, np.int32)),
                        pa.array(tb.as_signed(window_minima(own, length))),
                        pa.array(tb.as_signed(full_hash(own, at, length))),
                        pa.array(texts, pa.binary())], names=["item_id", "len", "fp", "wh", "text"])
                row += 1


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    ship_package(benchmark.sparkSession)
    items = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item_id"),
                             benchmark["text"].cast("string").alias("text"))
    return items.mapInArrow(_bench_windows, _BENCH)


class WindowIndex:
    """The windows of a bounded benchmark, for lookups inside a task."""

    def __init__(self, rows):
        self.items = sorted({r["item_id"] for r in rows})
        number = {x: i for i, x in enumerate(self.items)}
        self.by_length = {}
        for length in sorted({r["len"] for r in rows}):
            owners: dict[bytes, set[int]] = {}
            hashes: dict[bytes, tuple[int, int]] = {}
            for r in rows:
                if r["len"] == length:
                    text = bytes(r["text"])
                    owners.setdefault(text, set()).add(number[r["item_id"]])
                    hashes[text] = (r["fp"] % 2**64, r["wh"] % 2**64)
            self.by_length[length] = (
                np.unique(np.array([h[0] for h in hashes.values()], np.uint64)),
                {hashes[t][1]: (t, sorted(o)) for t, o in owners.items()})

    def matches(self, data, starts, ends, cut, words):
        """(first word, length, item numbers) of every window that occurs."""
        for length, (prints, windows) in self.by_length.items():
            low = window_minima(words, length)
            if not len(low):
                continue
            table = np.zeros(1 << 16, bool)
            table[(prints & np.uint64(0xFFFF)).astype(np.int64)] = True
            at = np.flatnonzero(table[(low & np.uint64(0xFFFF)).astype(np.int64)])
            at = at[np.isin(low[at], prints)]                        # joined fingerprints
            at = at[window_starts(cut, length)[at]]
            for s, h in zip(at.tolist(), full_hash(words, at, length).tolist()):  # extension
                found = windows.get(h)
                if found and found[0] == b" ".join(data[starts[i]:ends[i]].tobytes() for i in range(s, s + length)):
                    yield s, length, found[1]


_RESULT = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


_NO_ITEMS = _digest([])


def score_rows(index: WindowIndex, column):
    """(n_words, n_hit, sets of item numbers by row) over a whole text column."""
    n_words, n_hit, items = [], [], []
    for data, starts, ends, cut, words in batch_words(column):
        cover = np.zeros(len(words) + 1, np.int64)
        own: dict[int, set[int]] = {}
        for s, length, who in index.matches(data, starts, ends, cut, words):
            cover[s] += 1
            cover[s + length] -= 1
            own.setdefault(int(np.searchsorted(cut, s, "right")) - 1, set()).update(who)
        hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
        n_words.append(np.diff(cut))
        n_hit.append(hit[cut[1:]] - hit[cut[:-1]])
        items += [own.get(i, ()) for i in range(len(cut) - 1)]
    cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return cat(n_words), cat(n_hit), items


def _scorer(index):
    def run(batches):
        for batch in batches:
            n_words, n_hit, items = score_rows(index.value, batch.column(1))
            names = index.value.items
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([_digest(names[i] for i in x) if x else _NO_ITEMS for x in items], pa.string()),
                pa.array((n_hit > 0) & (MIN_SHARE * n_hit >= n_words)),
            ], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return run


def _bounded_index(benchmark: DataFrame, limit: int):
    """A broadcast index, or None when the benchmark has more than ``limit`` windows."""
    windows = benchmark_windows(benchmark)
    rows = windows.limit(limit + 1).collect()      # at most limit + 1 rows reach the driver
    return benchmark.sparkSession.sparkContext.broadcast(WindowIndex(rows)) if len(rows) <= limit else None


# --- beyond the broadcast bound: the same joins by shuffle ------------------------

def _doc_prints(lengths):
    def run(batches):
        for batch in batches:
            row = 0
            for _, _, _, cut, words in batch_words(batch.column(2)):
                for length in lengths:
                    low = window_minima(words, length)
                    fits = np.flatnonzero(window_starts(cut, length)[:len(low)])
                    who = np.searchsorted(cut, fits, "right") - 1
                    low = low[fits]
                    new = np.ones(len(low), bool)
                    new[1:] = (low[1:] != low[:-1]) | (who[1:] != who[:-1])
                    at = pa.array(who[new] + row)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(at), batch.column(1).take(at),
                        pa.array(np.full(int(new.sum()), length, np.int32)), pa.array(tb.as_signed(low[new]))],
                        names=["doc_id", "rk", "len", "fp"])
                row += len(cut) - 1
    return run


def _doc_windows(lengths):
    def run(batches):
        for batch in batches:
            row = 0
            for _, _, _, cut, words in batch_words(batch.column(2)):
                for length in lengths:
                    fits = np.flatnonzero(window_starts(cut, length))
                    who = np.searchsorted(cut, fits, "right") - 1
                    at = pa.array(who + row)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(at), batch.column(1).take(at), pa.array(fits - cut[who]),
                        pa.array(np.full(len(fits), length, np.int32)),
                        pa.array(tb.as_signed(full_hash(words, fits, length)))],
                        names=["doc_id", "rk", "start", "len", "wh"])
                row += len(cut) - 1
    return run


def _count_words(batches):
    for batch in batches:
        n = [np.diff(cut) for _, _, _, cut, _ in batch_words(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                          pa.array(np.concatenate(n) if n else [], pa.int64())], names=["doc_id", "rk", "n_words"])


def _cut_windows(batches):
    """The words of the windows at the given places, joined by spaces."""
    for batch in batches:
        ids, starts_, lengths_, texts = [], [], [], []
        row = 0
        for data, starts, ends, cut, _ in batch_words(batch.column(2)):
            for lo in cut[:-1].tolist():
                for x in batch.column(3)[row].as_py():
                    first = lo + x["start"]
                    ids.append(row)
                    starts_.append(x["start"])
                    lengths_.append(x["len"])
                    texts.append(b" ".join(data[starts[i]:ends[i]].tobytes() for i in range(first, first + x["len"])))
                row += 1
        take = pa.array(ids, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(starts_, pa.int64()),
                                          pa.array(lengths_, pa.int32()), pa.array(texts, pa.binary())], names=["doc_id", "rk", "start", "len", "text"])


def _row_key(docs: DataFrame):
    """Rows that share a doc_id differ by their text."""
    return F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))


def contamination_by_shuffle(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The result of ``contamination`` (and a row key) with both sides shuffled: a benchmark of any size."""
    staging, docs = Staging(docs.sparkSession, "decontam"), keys_and_text(docs)
    keyed = docs.select("doc_id", _row_key(docs).alias("rk"), "text")
    windows = benchmark_windows(benchmark)
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())   # 1 to 13
    prints = keyed.mapInArrow(_doc_prints(lengths), "doc_id bigint, rk bigint, len int, fp bigint")
    same = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("rk") == F.col("c_rk"))
    candidates = prints.join(windows.select("len", "fp").distinct(), ["len", "fp"]).select(
        F.col("doc_id").alias("c_id"), F.col("rk").alias("c_rk")).distinct()
    near = keyed.join(candidates, same, "left_semi").dropDuplicates(["doc_id", "rk"])
    likely = near.mapInArrow(_doc_windows(lengths), "doc_id bigint, rk bigint, start bigint, len int, wh bigint").join(
        windows.select("len", "wh").distinct(), ["len", "wh"], "left_semi")
    at = likely.groupBy(F.col("doc_id").alias("c_id"), F.col("rk").alias("c_rk")).agg(
        F.collect_list(F.struct("start", "len")).alias("at"))                  # no longer than the document
    cut = near.join(at, same).select("doc_id", "rk", "text", "at").mapInArrow(
        _cut_windows, "doc_id bigint, rk bigint, start bigint, len int, text binary")
    # Equal windows stand for the set of items that hold them, so a passage of many items
    # and documents gives one row a document, not one a document and item.
    held = windows.groupBy("len", "text").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    held = held.withColumn("set", F.sha2(F.to_json("items"), 256))
    hits = staging.save(cut.join(held.select("len", "text", "set"), ["len", "text"]).select("doc_id", "rk", "start", "len", "set"), "hits")
    words = hits.select("doc_id", "rk", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("w")).distinct().groupBy(
        F.col("doc_id").alias("c_id"), F.col("rk").alias("c_rk")).agg(F.count(F.lit(1)).alias("n_hit"))
    sets = hits.groupBy("doc_id", "rk").agg(F.array_sort(F.collect_set("set")).alias("sets")).withColumn("key", F.sha2(F.array_join("sets", ","), 256))
    members = held.select("set", "items").dropDuplicates(["set"])
    items = sets.select("key", "sets").dropDuplicates(["key"]).select("key", F.explode("sets").alias("set")).join(members, "set").groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    items = sets.join(items, "key").select(F.col("doc_id").alias("i_id"), F.col("rk").alias("i_rk"), "items")
    counted = keyed.mapInArrow(_count_words, "doc_id bigint, rk bigint, n_words bigint")
    out = counted.join(words, same, "left").join(
        items, F.col("doc_id").eqNullSafe(F.col("i_id")) & (F.col("rk") == F.col("i_rk")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select("doc_id", "rk", "n_words", n_hit.alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                      F.sha2(F.coalesce(F.array_join(F.array_sort("items"), ","), F.lit("")), 256).alias("items_sha256"),
                      ((n_hit > 0) & (MIN_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame, max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """Per document: words, hit words, items with occurring windows, contaminated."""
    index = _bounded_index(benchmark, max_broadcast_windows)
    if index is None:
        return contamination_by_shuffle(docs, benchmark).drop("rk")
    return keys_and_text(docs).mapInArrow(_scorer(index), _RESULT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """The documents that are not contaminated, all columns kept."""
    index = _bounded_index(benchmark, max_broadcast_windows)
    if index is None:
        bad = contamination_by_shuffle(docs, benchmark).where("contaminated").select(
            F.col("doc_id").alias("_bad_id"), F.col("rk").alias("_bad_key")).distinct()
        return docs.join(bad, (_row_key(docs) == bad["_bad_key"]) & docs["doc_id"].cast("bigint").eqNullSafe(bad["_bad_id"]), "left_anti")
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            n_words, n_hit, _ = score_rows(index.value, batch.column(at))
            yield batch.filter(pa.array((n_hit == 0) | (MIN_SHARE * n_hit < n_words)))

    return docs.mapInArrow(run, docs.schema)


def decontamination_query(spark, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


ORACLE = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
l AS (SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM w),
b AS (SELECT id AS item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
        lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win FROM l WHERE kind = 'b' AND len(w) > 0),
n AS (SELECT DISTINCT n FROM b),
d AS (SELECT id AS doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM l, n WHERE kind = 'd' AND len(w) >= n),
x AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM d),
h AS (SELECT doc_id, x.n, s, item_id FROM x JOIN b USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id)
SELECT l.id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM l LEFT JOIN c ON c.doc_id = l.id LEFT JOIN i ON i.doc_id = l.id WHERE kind = 'd'
"""
