"""Document quality by a sparse rule ensemble (op 8).

1. Statistics of every whole text in one pass (shares of character kinds,
   repetition of words and lines, lengths).
2. A random forest of shallow trees on a bounded sample of labelled rows; each
   path from a root to a node is a rule, a conjunction of thresholds.
3. Lasso-penalised logistic regression weighs the rules; most weights are zero.
4. The rules left are compiled into one Spark column expression, the score.

Labels come from at most ``labels.MAX_LABELS`` rows, never from ids with
``crc32(doc_id as text) mod 4 = 2``; labels, lang, source and doc_id enter no
score.

Defined cases: null text counts as empty (all statistics 0) and is scored like
any; with labels of one kind only, every score is that kind; without labels it
is 0; a null doc_id is not held out and not learned from; repeated rows get a
row each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm import textbytes as tb
from shoplens.llm.labels import MAX_LABELS, label_sample
from shoplens.llm.langid import held_out
from shoplens.llm.staging import Staging, documents, keys_and_text

GOOD = 0.7
STATS = ("words", "mean_word", "letters", "digits", "symbols", "upper", "spaces", "distinct_words", "top_word", "repeated_next",
         "distinct_lines", "mean_line", "short_lines", "symbol_words", "first_upper", "stops")
TREES, DEPTH, LASSO = 20, 3, 0.0005


def _kinds() -> np.ndarray:
    kind = np.zeros((6, 256), bool)
    letters, digits, upper, space, line = range(5)
    kind[letters, [*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    kind[digits, 48:58] = True
    kind[upper, 65:91] = True
    kind[space, [9, 10, 11, 12, 13, 32]] = True
    kind[line, 10] = True
    kind[5, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
    kind[5, [33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = False       # common punctuation is no symbol
    return kind


_KINDS = _kinds()


def text_statistics(column) -> np.ndarray:
    """One row of ``STATS`` a text."""
    raw, offsets = tb.utf8_column(column)
    out = []
    for a, b in tb.slices(offsets):
        data = raw[offsets[a]:offsets[b]]
        off = offsets[a:b + 1] - offsets[a]
        count = lambda m: np.diff(np.concatenate([[0], np.cumsum(m)])[off])
        size = np.maximum(np.diff(off), 1)
        letters, digits, upper, spaces, lines, symbols = (count(k[data]) for k in _KINDS)
        starts, ends, cut = tb.spans(~_KINDS[3][data], off)
        words = tb.span_hash(data, starts, ends)
        n = np.diff(cut)
        has_symbol = np.concatenate([[0], np.cumsum(_KINDS[5][data])])
        has_symbol = (has_symbol[ends] - has_symbol[starts]) > 0
        first_upper = _KINDS[2][data[starts]] if len(starts) else np.empty(0, bool)
        stop = np.isin(data[ends - 1], [33, 46, 63]) if len(ends) else np.empty(0, bool)
        ls, le, lcut = tb.spans(data != 10, off)
        line = tb.span_hash(data, ls, le)
        n_lines = np.diff(lcut)
        by_word = lambda m: np.diff(np.concatenate([[0], np.cumsum(m)])[cut])
        again = np.zeros(len(words), bool)
        again[1:] = words[1:] == words[:-1]
        inner = cut[:-1]
        again[inner[inner < len(words)]] = False
        short = np.diff(np.concatenate([[0], np.cumsum((le - ls) < 30)])[lcut])
        distinct, top, dlines = np.zeros(b - a), np.zeros(b - a), np.zeros(b - a)
        for i in range(b - a):
            if n[i]:
                w = np.sort(words[cut[i]:cut[i + 1]])
                edge = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1], [True]]))
                distinct[i], top[i] = len(edge) - 1, np.diff(edge).max()
            if n_lines[i]:
                dlines[i] = len(np.unique(line[lcut[i]:lcut[i + 1]]))
        n1, l1 = np.maximum(n, 1), np.maximum(n_lines, 1)
        # Type-token ratios fall with length; the root keeps them comparable.
        out.append(np.stack([np.log1p(n), by_word(ends - starts) / n1, letters / size, digits / size, symbols / size, upper / size,
                             spaces / size, distinct / n1, top / n1, by_word(again) / n1, dlines / l1, np.log1p(size / l1), short / l1,
                             by_word(has_symbol) / n1, by_word(first_upper) / n1, by_word(stop) / n1], axis=1))
    return np.concatenate(out) if out else np.empty((0, len(STATS)))


def _measure(batches):
    for batch in batches:
        m = text_statistics(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.round(m[:, j], 9)) for j in range(len(STATS))]], names=["doc_id", *STATS])


def statistics(docs: DataFrame) -> DataFrame:
    return keys_and_text(docs).mapInArrow(_measure, "doc_id bigint, " + ", ".join(f"{s} double" for s in STATS))


Rule = tuple[tuple[str, str, float], ...]


def tree_rules(node, path: Rule = ()) -> list[Rule]:
    """Every path from the root to a node below it."""
    out = [path] if path else []
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, at = STATS[split.featureIndex()], float(split.threshold())
        out += tree_rules(node.leftChild(), (*path, (name, "<=", at)))
        out += tree_rules(node.rightChild(), (*path, (name, ">", at)))
    return out


def rule_column(rule: Rule) -> Column:
    out = None
    for name, op, at in rule:
        c = F.col(name) <= F.lit(at) if op == "<=" else F.col(name) > F.lit(at)
        out = c if out is None else out & c
    return out


class QualityModel:
    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self) -> Column:
        """The ensemble as one column over ``STATS``."""
        logit = F.lit(self.intercept)
        for rule, weight in self.rules:
            logit = logit + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), logit))))


def fit(stats: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, staging: Staging | None = None) -> QualityModel:
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    staging = staging or Staging(stats.sparkSession, "quality")
    known = label_sample(labels, "quality", 4, 2, max_labels)
    rows = staging.save(stats.join(F.broadcast(known), "doc_id").withColumn("label", F.col("label").cast("double")), "labelled")
    kinds = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        return QualityModel([], 40.0 if 1.0 in kinds else -40.0)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=10,
                                    featureSubsetStrategy="onethird", seed=7)
    trees = forest.fit(VectorAssembler(inputCols=list(STATS), outputCol="x").transform(rows)).trees
    rules = sorted({r for t in trees for r in tree_rules(t._call_java("rootNode"))})
    columns = [rule_column(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)]
    fired = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(rows.select("label", *columns))
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=LASSO, standardization=True, maxIter=60).fit(
        fired.select("label", "x"))
    weights = lasso.coefficients.toArray()
    return QualityModel([(r, float(w)) for r, w in zip(rules, weights) if w], float(lasso.intercept))


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    return stats.select("doc_id", held_out().alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= GOOD).cast("int"))


def quality_query(spark, sf_dir: str) -> DataFrame:
    staging = Staging(spark, "quality")
    stats = staging.save(statistics(documents(spark, sf_dir)), "stats")
    return score(stats, fit(stats, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"), staging=staging))
