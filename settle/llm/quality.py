"""Quality scores by a sparse ensemble of rules.

Statistics of each text are computed once and stored. Shallow trees are grown
on the labelled rows, and each path from a root to a node is a rule, a
conjunction of thresholds on statistics. A logistic model with an L1 penalty
weighs the rules; those it leaves at zero are dropped. The remaining rules are
compiled into one Spark column expression, so scoring is a projection.

The model learns from labelled rows that are not held out, LEARN_ROWS of them
at most, drawn by a hash of the id. Everything else covers all rows.

Null texts count as empty; empty texts are scored like any other. A document
labelled several times counts with the rounded mean of its labels. Without
labels of both kinds every score is the smoothed share of label 1. Repeated
rows are scored one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from settle.llm.common import held_out, store, texts_of

LEARN_ROWS = 30_000
TREES, DEPTH = 24, 3
PENALTY = 0.001
THRESHOLD = 0.7
PARTS = 6  # partitions of the bounded learning rows

STATISTICS = (
    "log_chars", "log_words", "word_length", "letters", "digits", "upper", "symbols", "spaces", "distinct_words",
    "top_word", "repeated_word", "shouted_words", "bare_symbols", "marked_words", "short_words", "log_lines",
    "line_words", "repeated_lines", "stops",
)

# Classes of bytes; those of other scripts count as letters.
KIND = np.full(256, 4)
KIND[[9, 10, 11, 12, 13, 32]] = 3
KIND[0x30:0x3A] = 2
KIND[0x41:0x5B] = 1
KIND[0x61:0x7B] = KIND[0x80:] = 0


def statistics(text: str) -> list[float]:
    """Statistics of a whole text; an empty one has zeros."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    bytes_seen = np.bincount(data, minlength=256)
    lower, upper, digits, spaces, symbols = np.bincount(KIND, bytes_seen, minlength=5)
    size = max(len(data), 1)
    words = text.split()
    n = max(len(words), 1)
    seen = Counter(words)
    repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [line for line in text.split("\n") if line.strip()]
    line_seen = Counter(lines)
    return [
        np.log1p(len(text)), np.log1p(len(words)), len(text) / n, (lower + upper) / size, digits / size, upper / size,
        symbols / size, spaces / size, len(seen) / n, max(seen.values(), default=0) / n, repeated / n,
        sum(count for word, count in seen.items() if len(word) > 1 and word.isupper()) / n,
        sum(count for word, count in seen.items() if not any(map(str.isalnum, word))) / n,
        sum(count for word, count in seen.items() if not word[-2:].isalnum() and len(word) > 2 and not word[-2].isalnum()) / n,
        sum(count for word, count in seen.items() if len(word) <= 3) / n,
        np.log1p(len(lines)), len(words) / max(len(lines), 1),
        1 - len(line_seen) / max(len(lines), 1),
        (bytes_seen[ord(".")] + bytes_seen[ord("?")] + bytes_seen[ord("!")]) / n,
    ]


def with_statistics(documents: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of every document and its statistics, `_stat_` before their names."""
    names = [f"_stat_{s}" for s in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([statistics(text) for text in texts_of(batch.column(len(columns)))]).reshape(-1, len(names))
            arrays = [*batch.columns[: len(columns)], *[pa.array(column, pa.float64()) for column in made.T]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *names])

    schema = documents.select(*columns).schema
    for name in names:
        schema = schema.add(name, DoubleType())
    sent = documents.select(*columns, F.col("text")).toDF(*columns, "_text")
    return sent.mapInArrow(run, schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most, threshold) of every condition
CONDITION = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def tree_paths(debug: str) -> Iterator[Rule]:
    """Paths from the root to every node of a printed tree."""
    path: list[tuple[int, tuple[int, bool, float]]] = []
    for line in debug.splitlines():
        if not (found := CONDITION.match(line)):
            continue
        depth = len(found[1])
        path = [step for step in path if step[0] < depth]
        path.append((depth, (int(found[3]), found[4] == "<=", float(found[5]))))
        yield tuple(sorted({condition for _, condition in path}))


def holds(rule: Rule) -> Column:
    """A rule as a column expression."""
    conditions = []
    for statistic, at_most, threshold in rule:
        column = F.col(f"_stat_{STATISTICS[statistic]}")
        conditions.append(column <= threshold if at_most else column > threshold)
    return reduce(Column.__and__, conditions)


class Ensemble:
    """Rules with their weights and an intercept."""

    def __init__(self, intercept: float, weights: dict[Rule, float]):
        self.intercept, self.weights = intercept, weights

    def score(self) -> Column:
        """Probability of label 1 as a column over the statistics."""
        terms = [F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in self.weights.items()]
        return 1 / (1 + F.exp(-reduce(Column.__add__, terms, F.lit(self.intercept))))


def fit(marked: DataFrame, labels: DataFrame) -> Ensemble:
    """Learn from labelled rows of (doc_id, statistics) that are not held out."""
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        F.round(F.avg("quality")).alias("_label")
    )
    learning = marked.where(~held_out(F.col("doc_id"))).join(known, F.col("doc_id") == F.col("_id"))
    n = learning.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, LEARN_ROWS / max(n, 1)))
    features = F.array(*[F.col(f"_stat_{s}") for s in STATISTICS])
    drawn = store(learning.where(draw).select(*marked.columns, "_label").repartition(PARTS, "doc_id"), "quality_learning")
    totals = {row["_label"]: row["count"] for row in drawn.groupBy("_label").count().collect()}
    ones, every = totals.get(1.0, 0), sum(totals.values())
    bare = Ensemble(float(np.log((ones + 1) / (every - ones + 1))), {})
    if ones in (0, every):
        return bare
    assembled = drawn.select(array_to_vector(features).alias("features"), F.col("_label").alias("label"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", subsamplingRate=0.8, seed=5, maxBins=64
    ).fit(assembled)
    rules = sorted({rule for tree in forest.trees for rule in tree_paths(tree.toDebugString)})
    if not rules:  # no statistic tells the labels apart
        return bare
    design = F.array(*[F.when(holds(rule), 1.0).otherwise(0.0) for rule in rules])
    ruled = drawn.select(array_to_vector(design).alias("features"), F.col("_label").alias("label"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False).fit(ruled)
    weights = {rule: float(w) for rule, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w}
    return Ensemble(float(lasso.intercept), weights)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    marked = store(with_statistics(documents, ["doc_id"]), "quality_statistics")
    scored = marked.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), fit(marked, labels).score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
