"""A quality classifier from a sparse ensemble of rules.

Statistics of each whole text are Spark column expressions.  A forest of shallow trees is grown on
labelled rows; each path from a root is a conjunctive rule over statistics.  A logistic regression with a
lasso penalty weighs the rules and most get weight zero.  What is left is compiled into one Spark column, so
scoring is a projection.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, id_class, stored, table

TREES, DEPTH, LASSO, SEED = 20, 3, 0.002, 5
#: Labelled rows the ensemble is fitted to, on average, chosen by a hash of the id (all if there are no more); statistics cover all rows.
SAMPLE = 20_000
CUT = 0.3

Rule = tuple[tuple[str, str, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; a null text counts as empty.  Shares are 0 where there is nothing to share."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    chars = F.greatest(F.length(text), F.lit(1))
    n = F.greatest(F.size(words), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / chars

    return {
        "log_chars": F.log1p(F.length(text)),
        "mean_word": F.length(text) / n,
        "symbols": share("[#*$%&<>]"),
        "bars": share(r"\|"),
        "capitals": share("[A-Z]"),
        "exclaims": share("!"),
        "digits": share("[0-9]"),
        "stops": share(r"[.,;:?]"),
        "lines": share("\n"),
        "distinct_words": F.size(F.array_distinct(words)) / n,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "long_words": F.size(F.filter(words, lambda w: F.length(w) > 12)) / n,
        "brackets": share(r"[()\[\]{}]"),
        "links": F.regexp_count(text, F.lit("https?://|www[.]")) / n,
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", *[c.cast("double").alias(k) for k, c in statistics(F.col("text")).items()])


def condition(rule: Rule) -> Column:
    parts = [F.col(k) <= v if op == "<=" else F.col(k) > v for k, op, v in rule]
    return reduce(lambda a, b: a & b, parts)


_BRANCH = re.compile(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEeNaInfity]+)\)")


def paths(tree: str, names: list[str]) -> list[Rule]:
    """All paths from the root of a tree, to inner nodes and to leaves, from the text that describes it (``toDebugString``)."""
    found: list[Rule] = []
    above: list[tuple[int, tuple[str, str, float]]] = []
    for line in tree.split("\n"):
        m = _BRANCH.match(line)
        if m:
            depth = len(m.group(1))
            above = [x for x in above if x[0] < depth]
            above.append((depth, (names[int(m.group(2))], m.group(3), float(m.group(4)))))
            found.append(tuple(c for _, c in above))
    return found


def simplified(rule: Rule) -> Rule:
    """One bound of each kind per statistic, the tightest; in a fixed order."""
    bounds: dict[tuple[str, str], float] = {}
    for k, op, v in rule:
        old = bounds.get((k, op))
        bounds[k, op] = v if old is None else min(old, v) if op == "<=" else max(old, v)
    return tuple(sorted((k, op, v) for (k, op), v in bounds.items()))


def fit(rows: DataFrame, sample: int = SAMPLE) -> dict:
    """Learn from rows of statistics with an integer ``label`` 0 or 1; returns the bias and the weighted rules.

    Without rows, or with one label only, there are no rules and the bias is the label's log odds (add one).
    """
    names = [c for c in rows.columns if c not in ("doc_id", "label")]
    chosen = rows.where(hash_share(F.xxhash64("doc_id"), sample, rows.count()))
    rows = stored(chosen.withColumn("label", F.col("label").cast("double"))).repartition(4).cache()
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = counts.get(1.0, 0), counts.get(0.0, 0)
    if not ones or not zeros:
        rows.unpersist()
        return {"bias": math.log((ones + 1) / (zeros + 1)), "rules": []}
    features = VectorAssembler(inputCols=names, outputCol="x").transform(rows).select("x", "label")
    forest = RandomForestClassifier(featuresCol="x", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", seed=SEED, minInstancesPerNode=3, maxBins=64).fit(features)
    rules = sorted({simplified(r) for t in forest.trees for r in paths(t.toDebugString, names)})
    columns = [condition(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)]
    marked = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="x").transform(rows.select("label", *columns)).select("x", "label")
    lasso = LogisticRegression(featuresCol="x", elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(marked)
    rows.unpersist()
    weights = lasso.coefficients.toArray()
    return {"bias": float(lasso.intercept), "rules": [(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]}


def compiled(model: dict) -> Column:
    """The ensemble as one column over statistics: the probability of label 1."""
    total = reduce(lambda a, b: a + b, [F.when(condition(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in model["rules"]], F.lit(model["bias"]))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def classify(docs: DataFrame, labels: DataFrame, training: Column, cut: float = CUT) -> DataFrame:
    """Per row of ``docs``: doc_id, ``score`` and ``predicted``.

    Learns from rows where ``training`` (over doc_id) holds and ``labels.quality`` is 0 or 1; several labels of an id count once, the
    greatest.  A null or empty text has statistics of an empty text and a score like any other.  Repeated rows are scored one by one; other
    columns are not read; an empty table gives an empty result.
    """
    stats = stored(with_statistics(docs.select("doc_id", "text")))
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("label"))
    model = fit(stats.where(training).join(known, "doc_id"))
    score = compiled(model)
    return stats.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op3_rule_ensemble(spark, sf_dir):
    held_out = id_class(F.col("doc_id"), 5) == 0
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")
