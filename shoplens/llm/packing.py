"""Best-fit packing of documents into fixed-length sequences (op 3).

A document is its token ids and an end id.  A longer one than a sequence is cut
into whole sequences and one shorter piece, its first; the others stay whole.
Whole pieces are sequences of their own, the rest is bin packing, done by a
grouping genetic algorithm whose genes are sequences:

* crossover injects whole well-filled sequences of one parent into the other,
  removes the other's sequences that hold a document twice, and puts the
  documents these displaced back by best fit;
* mutation dissolves the emptiest sequences the same way;
* fitness is the number of sequences, then the sum of squared fills: with equally
  many sequences, one whose free space lies in few of them is better.

Islands are shards of the pieces, of bounded size, evolved in parallel tasks.
After an epoch the elite (sequences filled to ``ELITE``) is settled, and all
other sequences migrate, whole, into fewer islands, where they are a parent of
the next population.  Epochs end with a single island or when merging no longer
frees pieces.  A population evolves for ``LEAST`` generations at least and until it
meets the lower bound ``ceil(ids / sequence length)``.

Defined cases: null text is the end id alone; repeated rows are packed once
each; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.staging import Staging, documents, keys_and_text
from shoplens.llm.tokens import encode_column

SEQUENCE = 2048
END_ID = 0
ISLAND_PIECES = 4096
ELITE = 0.995
MAX_EPOCHS = 6
POPULATION, LEAST = 6, 10
GENERATIONS, MOST = 160, 2000       # of an island of ISLAND_PIECES, and of a small one

_PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(path: str, size: int, end_id: int):
    def run(batches):
        for batch in batches:
            row = 0
            for ids, off in encode_column(batch.column(1), path, True, end_id):
                data = memoryview(ids.tobytes())
                docs, piece, start, length, crc = [], [], [], [], []
                for i, (lo, hi) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
                    total = hi - lo
                    n = -(-total // size)
                    at = 0
                    for k in range(n):
                        end = total - size * (n - 1 - k)
                        docs.append(row + i)
                        piece.append(k)
                        start.append(at)
                        length.append(end - at)
                        crc.append(zlib.crc32(data[4 * (lo + at):4 * (lo + end)]))
                        at = end
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(docs, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
                row += len(off) - 1
    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Per piece of at most ``size`` ids: doc_id, piece, start, length, ids_crc32."""
    return keys_and_text(docs).mapInArrow(_pieces(tokenizer_path, size, end_id), _PIECE)


class OpenBins:
    """Free space of open sequences, for best fit."""

    def __init__(self):
        self.frees: list[int] = []
        self.by_free: dict[int, list[int]] = {}

    def add(self, bin_: int, free: int) -> None:
        if free > 0:
            own = self.by_free.get(free)
            if own is None:
                self.by_free[free] = [bin_]
                insort(self.frees, free)
            else:
                own.append(bin_)

    def take(self, length: int):
        """The bin with the least free space that holds ``length``, and that space; or None."""
        i = bisect_left(self.frees, length)
        if i == len(self.frees):
            return None
        free = self.frees[i]
        own = self.by_free[free]
        bin_ = own.pop()
        if not own:
            del self.by_free[free]
            del self.frees[i]
        return bin_, free


def best_fit(lengths: list[int], order, size: int, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Puts the items of ``order`` into ``bins`` (extended) by best fit."""
    bins = [] if bins is None else bins
    open_ = OpenBins()
    for b, own in enumerate(bins):
        open_.add(b, size - sum(lengths[i] for i in own))
    for i in order:
        n = lengths[i]
        got = open_.take(n)
        if got is None:
            bins.append([i])
            open_.add(len(bins) - 1, size - n)
        else:
            bins[got[0]].append(i)
            open_.add(got[0], got[1] - n)
    return bins


class Packing:
    """An individual: sequences (lists of item numbers), their fills and fitness."""

    __slots__ = ("bins", "fills", "fitness")

    def __init__(self, bins: list[list[int]], lengths: list[int], size: int):
        self.bins = bins
        self.fills = np.array([sum(map(lengths.__getitem__, b)) for b in bins])
        self.fitness = (-len(bins), float(((self.fills / size) ** 2).sum()))


def crossover(a: Packing, b: Packing, lengths, size, rng) -> list[list[int]]:
    """``a`` with whole well-filled sequences of ``b`` injected."""
    best = np.argsort(-b.fills, kind="stable")[:max(1, len(b.bins) // 2)]
    donors = [b.bins[i] for i in rng.choice(best, size=max(1, len(best) // 2), replace=False)]
    taken = bytearray(len(lengths))
    for x in donors:
        for i in x:
            taken[i] = 1
    child, displaced = [list(x) for x in donors], []
    for x in a.bins:
        if any(map(taken.__getitem__, x)):
            displaced += [i for i in x if not taken[i]]
        else:
            child.append(list(x))
    displaced.sort(key=lengths.__getitem__, reverse=True)
    return best_fit(lengths, displaced, size, child)


def noisy_order(items: list[int], lengths: list[int], least: float, rng) -> list[int]:
    """The items by falling length, each length taken for ``least`` to 1 of itself."""
    weight = np.array([lengths[i] for i in items]) * rng.uniform(least, 1.0, len(items))
    return [items[i] for i in np.argsort(-weight, kind="stable").tolist()]


def mutate(bins, lengths, size, rng) -> list[list[int]]:
    """Dissolves some of the emptiest sequences and a few random ones, and puts their documents back by best fit."""
    fills = np.array([sum(map(lengths.__getitem__, b)) for b in bins])
    loose = int((fills < size * rng.choice([ELITE, 1.0])).sum())
    k = int(rng.integers(2, 2 * loose + 3))
    gone = set(np.argsort(fills, kind="stable")[:k].tolist())
    gone |= set(rng.choice(len(bins), size=min(len(bins), int(rng.integers(1, 4 + k // 2))), replace=False).tolist())
    free = [i for b in sorted(gone) for i in bins[b]]
    order = noisy_order(free, lengths, rng.choice([0.8, 0.9, 0.97, 0.99, 1.0]), rng)
    return best_fit(lengths, order, size, [list(x) for b, x in enumerate(bins) if b not in gone])


def evolve(lengths: list[int], size: int, seed: int, groups: list[list[int]] | None = None,
           population: int = POPULATION, generations: int | None = None, log: dict | None = None) -> list[list[int]]:
    """Sequences (lists of item numbers) for one island; ``groups``: migrated sequences, a first parent.

    The first population is packed in random and in roughly falling order.  It evolves
    for ``LEAST`` generations, then until the lower bound is met.  If half of the
    generations haven't met it, best fit decreasing joins as an immigrant, so the
    result is never worse.  ``log`` receives the crossovers and the sequences of the
    first population.
    """
    if not lengths:
        return []
    if generations is None:                        # a small island's generations are cheap
        generations = min(MOST, max(GENERATIONS, GENERATIONS * ISLAND_PIECES // len(lengths)))
    lower = -(-sum(lengths) // size)
    rng = np.random.default_rng(seed)
    items = list(range(len(lengths)))
    people = [Packing(groups, lengths, size)] if groups else []
    while len(people) < population:
        order = rng.permutation(len(lengths)).tolist() if len(people) % 2 else noisy_order(items, lengths, 0.9, rng)
        people.append(Packing(best_fit(lengths, order, size), lengths, size))
    rank = lambda p: p.fitness
    people.sort(key=rank, reverse=True)
    if log is not None:
        log.update(crossovers=0, first=len(people[0].bins))
    for g in range(generations):
        if g >= LEAST and len(people[0].bins) <= lower:
            break
        if g == generations // 2 and len(people[0].bins) > lower:
            falling = sorted(items, key=lengths.__getitem__, reverse=True)
            people = sorted([*people[:-1], Packing(best_fit(lengths, falling, size), lengths, size)], key=rank, reverse=True)
        a, b = (people[int(min(rng.choice(population, size=2)))] for _ in range(2))     # tournaments
        child = mutate(crossover(a, b, lengths, size, rng), lengths, size, rng)
        people = sorted([*people[:-1], Packing(child, lengths, size)], key=rank, reverse=True)
        if log is not None:
            log["crossovers"] += 1
    return people[0].bins


_PACKED = _PIECE + ", sequence_id bigint, offset bigint, settled boolean"


def _island(size: int, epoch: int, last: bool):
    """One island and epoch: pieces (with the sequence they migrated in) -> pieces with their sequence."""
    def run(key, pdf):
        island = int(key[0])
        pdf = pdf.sort_values(["sequence_id", "length", "doc_id", "piece"], ascending=[True, False, True, True], ignore_index=True)
        groups = None
        if epoch:
            groups = [list(x) for x in pdf.groupby("sequence_id", sort=False).indices.values()]
        lengths = pdf["length"].tolist()
        bins = evolve(lengths, size, seed=1000 * epoch + island, groups=groups)
        order = [i for b in bins for i in b]
        out = pdf.take(order).reset_index(drop=True)
        count = np.array([len(b) for b in bins])
        number = np.repeat(np.arange(len(bins)), count)
        before = np.concatenate([[0], np.cumsum(out["length"].to_numpy())])
        first = np.repeat(np.cumsum(count) - count, count)
        fill = np.bincount(number, weights=out["length"].to_numpy())
        out["sequence_id"] = ((epoch + 1) << 56) + (island << 24) + number
        out["offset"] = before[:-1] - before[first]
        out["settled"] = (fill >= ELITE * size)[number] | last
        return out[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "settled"]]
    return run


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID,
         island_pieces: int = ISLAND_PIECES) -> DataFrame:
    """All pieces with their sequence and the place in it."""
    st = Staging(docs.sparkSession, "packing")
    pieces = st.save(token_pieces(docs, tokenizer_path, size, end_id), "pieces")
    whole = pieces.where(F.col("length") == size)
    # Whole pieces are numbered by task and position of the written table.
    settled = [whole.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))]
    rest = pieces.where(F.col("length") < size).withColumn("sequence_id", F.lit(0).cast("bigint"))
    left = rest.count()
    islands, spread = None, F.monotonically_increasing_id()       # of the written rows: equal rows are spread as well
    for epoch in range(MAX_EPOCHS):
        n = max(1, -(-left // island_pieces))
        last = n == 1 or epoch == MAX_EPOCHS - 1 or (islands is not None and 2 * n > islands)
        islands = n
        shard = F.pmod(F.xxhash64(spread if epoch == 0 else F.col("sequence_id")), F.lit(n))
        out = rest.withColumn("island", shard).groupBy("island").applyInPandas(_island(size, epoch, last), _PACKED)
        out = st.save(out, f"epoch{epoch}")
        settled.append(out.where("settled").drop("settled"))
        if last:
            break
        rest = out.where("not settled").drop("settled", "offset")
        left = rest.count()
    result = settled[0]
    for part in settled[1:]:
        result = result.unionByName(part)
    return result


def packing_query(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), byte_bpe_path())


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
