"""Quality classifier as a sparse ensemble of rules (Friedman and Popescu, 2008).

Shallow trees are grown on text statistics; every path from a root to a node is a
conjunction of threshold tests. A lasso logistic regression over the rules keeps
the few that matter, and the kept rules become one Spark column expression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.llm.common import as_bytes, map_batches, own_names, stored
from replyscope.llm.statistics import CLASSES, base_statistics, class_counts

#: Names of the statistics; shares are of code points, words or lines.
FEATURES = tuple(f"share_{c}" for c in CLASSES) + ("log_words", "mean_word", "share_distinct", "share_repeated", "dup_lines", "share_symbols", "mean_line")
SAMPLE = 20_000  # labelled documents that are learned from, about
TREES = 20
DEPTH = 3
PENALTY = 0.002


@dataclass(frozen=True)
class Rule:
    tests: tuple[tuple[str, bool, float], ...]  # statistic, above?, threshold
    weight: float


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without its text, with the statistics of every whole text as
    columns. A null text counts as empty; statistics of an empty text are 0."""
    columns = [c for c in docs.columns if c != text and c not in FEATURES]

    def run(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            rows = np.array([_statistics(body) for body in part["_text"]]).reshape(-1, len(FEATURES))
            yield {c: part[c] for c in columns} | {name: rows[:, i] for i, name in enumerate(FEATURES)}

    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns] + [f"{name} double" for name in FEATURES]
    return map_batches(docs.select(*columns, as_bytes(text).alias("_text")), run, ", ".join(schema))


def _statistics(text: bytes | None) -> list[float]:
    counts, words, base = base_statistics(text)
    classes, n = class_counts(counts), max(len(words), 1)
    points, lines = max(int(classes.sum()), 1), int(counts[10]) + 1
    shares = (classes / points).tolist()
    rest = [
        np.log1p(len(words)), base["word_chars"] / n, len(set(words)) / n, base["n_repeat_words"] / n,
        base["n_dup_lines"] / lines, base["n_symbols"] / points, len(words) / lines,
    ]
    return shares + [float(x) for x in rest]


def learnable(labels: DataFrame, kept_back: Column, sample: int = SAMPLE, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(key, label) of about `sample` labelled documents that are not kept back,
    chosen by a hash of the key. Label 1 is 1, every other label 0; a document
    labelled twice has the lower one."""
    rows = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~kept_back)
    rows = rows.groupBy(key).agg(F.min((F.col(label) == 1).cast("double")).alias("label"))
    share = min(1.0, sample / max(rows.count(), 1))
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < share * (1 << 20))


def train(docs: DataFrame, chosen: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1) -> RuleModel:
    """Fits the ensemble to the bounded table `chosen` of (key, label). Without
    labelled documents the score is 0.5; with one class only, 0 or 1."""
    rows = docs.select(key, text).join(F.broadcast(chosen), key)  # bounded by the sample
    table = stored(statistics(rows, text), "statistics")
    seen = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    if len(seen) < 2:
        return RuleModel(0.0 if not seen else 50.0 if 1.0 in seen else -50.0, ())
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(table)
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", seed=seed
    ).fit(vectors)
    paths = sorted({path for tree in forest.trees for path in _paths(tree._call_java("rootNode"), ())})
    if not paths:
        share = seen.get(1.0, 0) / sum(seen.values())
        return RuleModel(float(np.log(share / (1 - share))), ())
    names = [f"r{i}" for i in range(len(paths))]
    fired = table.select("label", *[_fires(path).cast("double").alias(name) for name, path in zip(names, paths)])
    inputs = stored(VectorAssembler(inputCols=names, outputCol="vector").transform(fired).select("label", "vector"), "rules")
    lasso = LogisticRegression(featuresCol="vector", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=100)
    fit = lasso.fit(inputs)
    rules = tuple(Rule(path, float(w)) for path, w in zip(paths, fit.coefficients.toArray()) if w != 0.0)
    return RuleModel(float(fit.intercept), rules)


def _paths(node, tests: tuple) -> Iterator[tuple]:
    """The conjunctions that lead to a node and its descendants."""
    if tests:
        yield tests
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, limit = FEATURES[split.featureIndex()], float(split.threshold())
        yield from _paths(node.leftChild(), tuple(sorted({*tests, (name, False, limit)})))
        yield from _paths(node.rightChild(), tuple(sorted({*tests, (name, True, limit)})))


def _fires(tests: tuple[tuple[str, bool, float], ...]) -> Column:
    return reduce(Column.__and__, [F.col(name) > limit if above else F.col(name) <= limit for name, above, limit in tests])


def score_expression(model: RuleModel) -> Column:
    """Probability of label 1 over the columns of the statistics."""
    total = reduce(Column.__add__, [F.when(_fires(r.tests), r.weight).otherwise(0.0) for r in model.rules], F.lit(model.intercept))
    return 1 / (1 + F.exp(-total))


@own_names("score", "predicted")
def score(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """`docs` without its text, with score (0 to 1) and predicted (score >= 0.5).
    Null and empty texts are scored like any other; rows are never dropped;
    earlier columns score and predicted are replaced."""
    columns = [c for c in docs.columns if c not in (text, "score", "predicted", *FEATURES)]
    scored = statistics(docs.select(*columns, text), text).withColumn("score", score_expression(model))
    return scored.select(*columns, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
