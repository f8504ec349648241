"""Toxicity by maximum-scoring segments (op 9).

Token scores are log-odds between toxic and other labelled documents with an
informative Dirichlet prior, the token's share in the different texts of the whole
corpus, in proportion to each class; they count where they are significant (z-score),
all other tokens share a small negative drift.  How significant is chosen by
cross-validation inside the learnable rows: of ``CHANCE`` levels the one of least log
loss, each text scored by the counts of the other folds (copies of a text are in one fold).
A linear-time scan (Ruzzo-Tompa) finds every maximal-scoring segment of a text.  Segment scores are calibrated as extreme values: with the decay lambda
of the clean token distribution and the clean rate K, a document of n tokens has
``K n exp(-lambda S)`` segments of score S by chance.  The document's score is a
logistic function of its best segment's calibrated score; K and the logistic function
come from the same scores without own fold.

Tokens are words (runs of ``[0-9a-z]`` and non-ASCII characters, A-Z
lower-cased), hashed; a word without significant evidence of its own backs off to
its leading 6, 5 or 4 bytes, so unseen endings of a known stem count.  The tables have
``BUCKETS`` places, a fixed bound.  Corpus counts cover all documents, copies
of a text once; labels
come from a bounded sample (``labels.MAX_LABELS``), never from ids with
``crc32(doc_id as text) mod 5 = 0``.

Defined cases: null or word-less text scores as a text without toxic tokens;
with no labels of both kinds every score is 0; a null doc_id is not held out and
not learned from; repeated rows get a row each; other columns are ignored.  A text is
scanned whole whatever its length, in linear time and a slice's memory; levels of equal
log loss go to the strictest, a score of exactly 0.5 is predicted 1.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import textbytes as tb
from shoplens.llm.decontam import batch_words
from shoplens.llm.labels import MAX_LABELS, label_sample
from shoplens.llm.langid import held_out
from shoplens.llm.staging import Staging, documents

BUCKETS = 1 << 20
STEMS = (6, 5, 4)
PRIOR = 0.05         # weight of the Dirichlet prior, as a share of the labelled counts
CHANCE = (100.0, 10.0, 1.0, 0.1, 0.01)   # levels: toxic features expected by chance; cross-validation picks one
MIN_Z = 2.0          # least z-score of a toxic feature at any level
CLEAN_Z = -1.5       # up to this z-score a feature is known to be clean: no backing off
FOLDS = 4
MAX_GROUPS = 200_000 # groups of exact copies that are broadcast
DRIFT = -0.05
SATURATED = 20.0
SIGNIFICANT = 0.01   # segments with fewer chance occurrences a document are passages


def features(data, starts, ends, words) -> np.ndarray:
    """Buckets of each word and its stems, most specific first (a short word is its own stem)."""
    out = [words]
    for n in STEMS:
        cut = np.minimum(ends, starts + n)
        h = tb.span_hash(data, starts, cut) + np.uint64(n)
        out.append(tb.mix64(h))
    return (np.stack(out) % np.uint64(BUCKETS)).astype(np.int64)


def _count(kinds: int):
    """(text, kind, weight) -> per bucket the weights of the texts of each kind.

    A document counts a feature once, so one long document can't make a word significant.
    """
    def run(batches):
        total = np.zeros((kinds, BUCKETS))
        for batch in batches:
            kind, weight = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            row = 0
            for data, starts, ends, cut, words in batch_words(batch.column(0)):
                f = features(data, starts, ends, words)
                own_kind, own_weight = kind[row:row + len(cut) - 1], weight[row:row + len(cut) - 1]
                row += len(cut) - 1
                doc = np.repeat(np.arange(len(own_kind)), np.diff(cut))
                own = np.unique((doc * BUCKETS + f).ravel())
                doc, own = own // BUCKETS, own % BUCKETS
                for k in np.unique(own_kind):
                    here = own_kind[doc] == k
                    total[k] += np.bincount(own[here], own_weight[doc[here]], BUCKETS)
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(total[k][at]) for k in range(kinds)]],
                                         names=["bucket"] + [f"k{k}" for k in range(kinds)])

    return run


def tally(rows: DataFrame, kinds: int = 1, counts: str = "bigint") -> tuple[np.ndarray, np.ndarray]:
    """(buckets that occur, their counts by kind) of ``text, kind, weight``; at most BUCKETS rows are gathered."""
    names = [f"k{k}" for k in range(kinds)]
    table = rows.select("text", "kind", "weight").mapInArrow(_count(kinds), "bucket int, " + ", ".join(f"{k} double" for k in names)).groupBy(
        "bucket").agg(*[F.rint(F.sum(k)).cast(counts).alias(k) for k in names]).orderBy("bucket").toArrow()
    # Shares of copies add up to whole texts, whatever the order of the sum.
    return table["bucket"].to_numpy(), np.stack([table[k].to_numpy() for k in names])


def different_texts(rows: DataFrame, staging: Staging, max_groups: int = MAX_GROUPS) -> DataFrame:
    """``text, weight``: the weights of a text's exact copies add up to 1, however many there are."""
    rows = rows.select("text", F.xxhash64("text").alias("h"))
    groups = staging.save(rows.groupBy("h").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    if groups.count() <= max_groups:
        return rows.join(F.broadcast(groups), "h", "left").select("text", (1.0 / F.coalesce("copies", F.lit(1))).alias("weight"))
    # The texts themselves are shuffled, copies combined before.
    return rows.groupBy("h").agg(F.first("text").alias("text")).select("text", F.lit(1.0).alias("weight"))


class ToxicityModel:
    """Log-odds and z-scores over BUCKETS (NaN: none), the z-score from which a feature counts, and the calibration."""

    def __init__(self, odds=None, z=None, at=0.0, decay=1.0, rate=1.0, slope=0.0, shift=0.0):
        self.odds, self.z, self.at, self.decay, self.rate, self.slope, self.shift = odds, z, at, decay, rate, slope, shift

    def token_scores(self, f: np.ndarray, at: float | None = None) -> np.ndarray:
        """Scores of tokens by their ``features``: the most specific feature with evidence, else DRIFT."""
        at = self.at if at is None else at
        out = np.full(f.shape[1], np.nan)
        for level in f:
            z = self.z[level]
            own = np.where(z >= at, self.odds[level], np.where(z <= CLEAN_Z, DRIFT, np.nan))
            out = np.where(np.isnan(out), own, out)
        return np.where(np.isnan(out), DRIFT, out)

    def expected(self, score: float, n: int) -> float:
        """Chance segments of at least ``score`` in a clean text of ``n`` tokens."""
        return self.rate * max(n, 1) * math.exp(-self.decay * score)

    def calibrated(self, score: float, n: int) -> float:
        """Minus the logarithm of the expected chance segments, no more than SATURATED: beyond, all is certain alike."""
        return min(SATURATED, self.decay * score - math.log(self.rate * max(n, 1)))

    def probability(self, best: float | None, n: int) -> float:
        if best is None:
            return 0.0
        x = self.slope * self.calibrated(best, n) + self.shift
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, x))))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score), Ruzzo and Tompa's linear scan.

    Only the positive tokens are visited: a run of others between two of them
    adds its sum to the running total.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []          # [first, end, left total, right total, index of nearest lower left or -1]
    for i in np.flatnonzero(scores > 0).tolist():
        first, end, left, right = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append([first, end, left, right, j])
                break
            first, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - l) for a, b, l, r, _ in stack]


def document_segments(model: ToxicityModel, column):
    """Per row: (tokens, segments, byte starts and ends of its words in their slice)."""
    for data, starts, ends, cut, words in batch_words(column):
        s = model.token_scores(features(data, starts, ends, words))
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            own = s[lo:hi]
            yield hi - lo, maximal_segments(own) if (own > 0).any() else [], starts[lo:hi], ends[lo:hi]


def _best(segments):
    return max(x[2] for x in segments) if segments else None


def thresholds(tested: int) -> list[float]:
    """The z-score of each of CHANCE: from it on, that many of the tested features are expected by chance."""
    return [max(MIN_Z, NormalDist().inv_cdf(1.0 - min(0.5, c / max(tested, 2)))) for c in CHANCE]


def evidence(corpus: np.ndarray, n_all: float, toxic: np.ndarray, n_toxic: float, clean: np.ndarray, n_clean: float):
    """Per feature: log-odds, z-score and share of the clean features (NaN and 0 if one kind is missing).

    The prior is in proportion to each class, so it pulls a word towards no difference.
    """
    if not n_toxic or not n_clean:
        return np.full(len(corpus), np.nan), np.full(len(corpus), np.nan), np.zeros(len(corpus))
    yt, yc = toxic + PRIOR * n_toxic * corpus / n_all, clean + PRIOR * n_clean * corpus / n_all
    wt, wc = (1 + PRIOR) * n_toxic, (1 + PRIOR) * n_clean
    with np.errstate(divide="ignore", invalid="ignore"):      # the only word of its class: no evidence
        odds = np.log(yt / (wt - yt)) - np.log(yc / (wc - yc))
    odds = np.where(np.isfinite(odds), odds, np.nan)
    return odds, odds / np.sqrt(1.0 / yt + 1.0 / yc), yc / wc


def decay_of(p: np.ndarray, s: np.ndarray) -> float:
    """The positive root of  sum p exp(lambda s) = 1  over the clean distribution."""
    p_rest = max(1e-9, 1.0 - p.sum())
    lo, hi = 1e-3, 50.0
    for _ in range(60):
        mid = (lo + hi) / 2
        value = p_rest * math.exp(mid * DRIFT) + float(np.sum(p * np.exp(np.minimum(mid * s, 60.0))))
        lo, hi = (mid, hi) if value < 1.0 else (lo, mid)
    return lo


class Fold:
    """What the texts of some folds say: tables for the tasks, and a threshold, decay and least score a level."""

    def __init__(self, bucket, corpus, n_all, toxic, n_toxic, clean, n_clean):
        odds, z, share = evidence(corpus, n_all, toxic, n_toxic, clean, n_clean)
        self.model = ToxicityModel(np.full(BUCKETS, np.nan, np.float32), np.full(BUCKETS, np.nan, np.float32))
        self.model.odds[bucket], self.model.z[bucket] = odds, z
        z = self.model.z[bucket]
        self.at = thresholds(int((toxic > 0).sum()))
        self.decay, self.low = [], []
        for at in self.at:
            counts = (z >= at) & (odds > 0)
            self.decay.append(decay_of(share[counts], odds[counts]))
            self.low.append(float(odds[counts].min()) if counts.any() else 1.0)

    def rate(self, level: int, segments: int, tokens: int) -> float:
        return (segments + 0.5) / max(tokens, 1) * math.exp(self.decay[level] * self.low[level])

    def at_level(self, level: int, segments: int, tokens: int) -> ToxicityModel:
        """The model of a level, its chance rate from the segments in so many clean tokens."""
        return ToxicityModel(self.model.odds, self.model.z, self.at[level], self.decay[level], self.rate(level, segments, tokens))


def _measure(shared):
    """(text, label, fold) -> histogram cells of the segments that the other folds' tables find, at each level."""
    def run(batches):
        models = shared.value
        cells: dict[tuple, np.ndarray] = {}
        for batch in batches:
            labels, folds = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            row = 0
            for data, starts, ends, cut, words in batch_words(batch.column(0)):
                f, size = features(data, starts, ends, words), np.diff(cut)
                label, fold = labels[row:row + len(size)], folds[row:row + len(size)]
                row += len(size)
                for k in np.unique(fold):
                    own = fold == k
                    mine = f[:, np.repeat(own, size)]
                    edges = np.concatenate([[0], np.cumsum(size[own])]).tolist()
                    model, at = models[k]
                    for level in range(len(CHANCE)):
                        s = model.token_scores(mine, at[level])
                        for y, lo, hi in zip(label[own].tolist(), edges[:-1], edges[1:]):
                            segments = maximal_segments(s[lo:hi]) if (s[lo:hi] > 0).any() else []
                            best = round(_best(segments), 1) if segments else -1.0
                            key = (int(k), level, y, best, int(math.log2(max(hi - lo, 1))))
                            cells[key] = cells.get(key, 0) + np.array([1, hi - lo, len(segments)])
        keys, values = list(cells), list(cells.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in keys], pa.float64() if i == 3 else pa.int32()) for i in range(5)]
            + [pa.array([int(v[i]) for v in values], pa.int64()) for i in range(3)],
            names=["fold", "level", "label", "best", "size", "docs", "tokens", "segments"])

    return run


def calibration(cells, folds: list[Fold], level: int) -> tuple[float, float, float, int, int]:
    """Of a level: (log loss, slope, shift, clean segments, clean tokens) over the texts, each scored without its own fold."""
    x, y, w, missed = [], [], [], np.zeros(2)
    all_segments = all_tokens = 0
    for k, fold in enumerate(folds):
        own = [c for c in cells if c["fold"] == k and c["level"] == level]
        segments = sum(c["segments"] for c in own if c["label"] == 0)
        tokens = sum(c["tokens"] for c in own if c["label"] == 0)
        all_segments, all_tokens = all_segments + segments, all_tokens + tokens
        model = fold.at_level(level, segments, tokens)
        for c in own:
            if c["best"] < 0:
                missed[c["label"]] += c["docs"]
            else:
                x.append(model.calibrated(c["best"], 2 ** c["size"]))
                y.append(c["label"])
                w.append(c["docs"])
    x, y, w = np.array(x), np.array(y, float), np.array(w, float)
    slope, shift = logistic_fit(x, y, w)
    p = 1.0 / (1.0 + np.exp(-np.clip(slope * x + shift, -30, 30)))
    # Texts without a toxic token share one probability, their own rate.
    p0 = (missed[1] + 0.5) / (missed.sum() + 1)
    loss = -float(np.sum(w * (y * np.log(p) + (1 - y) * np.log(1 - p)))) - missed[1] * math.log(p0) - missed[0] * math.log(1 - p0)
    return round(loss, 6), slope, shift, all_segments, all_tokens


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> ToxicityModel:
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    staging = Staging(spark, "toxicity")
    known = F.broadcast(label_sample(labels, "toxic", 5, 0, max_labels))              # at most max_labels rows
    # Of exact copies with one label a single row is learned from, so a group of copies can't make its words significant.
    known = rows.join(known, "doc_id").groupBy(F.xxhash64("text").alias("h"), "label").agg(F.first("text").alias("text"))
    known = staging.save(known.select("text", "label", F.pmod("h", F.lit(FOLDS)).cast("int").alias("fold")), "labels")
    bucket, counts = tally(known.select("text", (F.col("fold") * 2 + F.col("label")).alias("kind"), F.lit(1.0).alias("weight")), 2 * FOLDS, "int")
    clean, toxic = (counts[i::2].astype(float) for i in (0, 1))
    n_clean, n_toxic = clean.sum(1), toxic.sum(1)
    if not n_toxic.sum() or not n_clean.sum():
        return ToxicityModel()
    seen, total = tally(different_texts(rows, staging).select("text", F.lit(0).alias("kind"), "weight"))
    n_all, corpus = float(total.sum()), np.zeros(BUCKETS)
    corpus[seen] = total[0]
    corpus = corpus[bucket]

    def without(*left_out: int) -> Fold:
        use = [k for k in range(FOLDS) if k not in left_out]
        return Fold(bucket, corpus, n_all, toxic[use].sum(0), n_toxic[use].sum(), clean[use].sum(0), n_clean[use].sum())

    # A text is judged by what the other folds say: the level and the calibration are of texts not counted.
    folds = [without(k) for k in range(FOLDS)]
    shared = spark.sparkContext.broadcast([(fold.model, fold.at) for fold in folds])
    key = ["fold", "level", "label", "best", "size"]
    cells = known.mapInArrow(_measure(shared), "fold int, level int, label int, best double, size int, docs bigint, tokens bigint, segments bigint").groupBy(
        *key).agg(*[F.sum(c).alias(c) for c in ("docs", "tokens", "segments")]).orderBy(*key).collect()   # histogram cells
    found = {level: calibration(cells, folds, level) for level in range(len(CHANCE))}
    level = min(found, key=lambda x: (found[x][0], -x))              # of equal losses the strictest level
    _, slope, shift, segments, tokens = found[level]
    model = without().at_level(level, segments, tokens)
    model.slope, model.shift = slope, shift
    return model


def logistic_fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope (not negative) and shift of a weighted logistic curve, Newton steps."""
    if not len(x):
        return 1.0, 0.0
    scale = max(float(np.std(x)), 1.0)
    a, b = 0.0, 0.0
    design = np.stack([x / scale, np.ones_like(x)])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * design[0] + b, -30, 30)))
        g = design @ (w * (y - p)) - ridge * np.array([a, 0.01 * b])
        h = (design * (w * p * (1 - p))) @ design.T + ridge * np.diag([1.0, 0.01])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -3, 3)), b + float(np.clip(step[1], -3, 3))
        if abs(step).max() < 1e-8:
            break
    return max(0.0, a / scale), b


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and its significant passages (start:end in code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            scores, passages = [], []
            if m.odds is None:
                scores, passages = [0.0] * batch.num_rows, [""] * batch.num_rows
            else:
                texts = batch.column(2)
                for i, (n, segments, starts, ends) in enumerate(document_segments(m, texts)):
                    scores.append(m.probability(_best(segments), n))
                    found = [(a, b) for a, b, s in segments if m.expected(s, n) <= SIGNIFICANT]
                    passages.append(_code_points(texts[i].as_py(), found, starts, ends) if found else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                                              pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(passages, pa.string())],
                                             names=["doc_id", "held_out", "score", "predicted", "passages"])

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.select("doc_id", held_out(parts=5, part=0).alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int, passages string")


def _code_points(text: str, found, starts, ends) -> str:
    raw = np.frombuffer(text.encode(), np.uint8)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    # Word offsets are those of the slice; the row's first word gives the difference.
    shift = int(np.argmax(tb.ALNUM_WORD[tb.LOWER[raw]])) - starts[0]
    return ",".join(f"{before[starts[a] + shift]}:{before[ends[b - 1] + shift]}" for a, b in found)


def toxicity_query(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score(docs, fit(docs, labels))
