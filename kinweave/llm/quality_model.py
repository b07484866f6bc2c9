"""Quality classifier: a sparse ensemble of rules.

Shallow random trees over statistics of the text give paths; each path is a rule, a
conjunction of thresholds. A lasso logistic regression keeps few rules and weighs them, and
the model is compiled into one Spark column: the logistic function of the weights of the
rules that hold. Scoring needs no Python and no model object.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm.common import ASCII_UPPER, SPACES, bounded_sample, let, split_words

#: Labelled documents that a model is fitted on, at most about.
SAMPLE = 20_000
TREES, DEPTH, LASSO = 12, 3, 0.002

FEATURES = ("log_words", "mean_word", "symbols", "upper", "exclaims", "stops", "digits", "short_words", "distinct", "same_as_last", "line_repeats")


def statistics(text: Column) -> Column:
    """Array of the statistics in ``FEATURES``; those of an empty text for null."""
    t = F.coalesce(text, F.lit(""))
    count = lambda letters: F.length(t) - F.length(F.translate(t, letters, ""))
    chars = F.greatest(F.length(F.translate(t, SPACES, "")), F.lit(1))
    lines = F.filter(F.split(t, "\n"), lambda x: x != "")
    line_repeats = let(lines, lambda x: 1 - F.size(F.array_distinct(x)) / F.greatest(F.size(x), F.lit(1)))

    def of_words(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        same = F.size(F.filter(F.zip_with(F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), w, lambda a, b: a == b), lambda x: x))
        return F.array(
            F.log1p(F.size(w).cast("double")), chars / n, count("#*$%&|<>") / chars, count(ASCII_UPPER) / chars, count("!") / n, count(".,;:") / n, count("0123456789") / chars,
            F.size(F.filter(w, lambda x: F.length(x) <= 3)) / n, F.size(F.array_distinct(w)) / n, same / n, line_repeats)

    return let(split_words(t), of_words)


#: A rule: thresholds on features, as (feature, above, threshold).
Rule = tuple[tuple[int, bool, float], ...]


def _paths(node, conditions: tuple = ()) -> list[tuple]:
    """Conditions on the way to every node below the root."""
    out = [conditions] if conditions else []
    if node.getClass().getSimpleName() == "InternalNode":
        f, x = node.split().featureIndex(), node.split().threshold()
        out += _paths(node.leftChild(), (*conditions, (f, False, x))) + _paths(node.rightChild(), (*conditions, (f, True, x)))
    return out


def _simplified(path: tuple) -> Rule:
    """The strictest threshold for each feature and side."""
    strict: dict[tuple[int, bool], float] = {}
    for f, above, x in path:
        strict[f, above] = (max if above else min)(strict.get((f, above), x), x)
    return tuple((f, above, x) for (f, above), x in sorted(strict.items()))


def holds(rule: Rule, stats: Column) -> Column:
    out = F.lit(True)
    for f, above, x in rule:
        out = out & (stats[f] > x if above else stats[f] <= x)
    return out


class RuleModel:
    """Weighted rules and an intercept."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self, stats: Column) -> Column:
        """Chance of label 1 as a column over an array of statistics."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, stats), float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def __str__(self) -> str:
        text = lambda r: " and ".join(f"{FEATURES[f]} {'>' if above else '<='} {x:.4g}" for f, above, x in r)
        return "\n".join([f"{self.intercept:+.3f}", *(f"{w:+.3f} if {text(r)}" for r, w in self.rules)])


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, seed: int = 0) -> RuleModel:
    """Model of ``doc_id, text`` and ``doc_id, label`` (0 or 1), from about ``most`` labels at most.

    The sampled labels are joined in memory, so texts aren't shuffled. An id with both labels
    counts as unlabelled; each row of a repeated document counts. With no label, or only one kind,
    the model is a constant.
    """
    stage = Staging(docs.sparkSession, "quality")
    known = labels.filter("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("label").cast("double").alias("label"), F.max("label").alias("most")).filter("label = most")
    chosen = stage.write(bounded_sample(known.select("doc_id", "label"), F.col("doc_id"), most), "labels")
    data = stage.write(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", statistics(F.col("text")).alias("stats")), "statistics")
    sums = data.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    ones = sums.ones or 0.0
    if not sums.n or ones in (0, sums.n):
        share = (ones + 0.5) / (sums.n + 1)
        return RuleModel([], math.log(share / (1 - share)))
    vectors = data.select("label", array_to_vector("stats").alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="0.5", minInstancesPerNode=max(2, int(sums.n * 0.002)), seed=seed).fit(vectors)
    rules = sorted({_simplified(p) for tree in forest.trees for p in _paths(tree._java_obj.rootNode())})
    if not rules:
        return RuleModel([], math.log(ones / (sums.n - ones)))
    indicators = stage.write(data.select("label", F.array(*[holds(r, F.col("stats")).cast("double") for r in rules]).alias("fits")), "rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(indicators.select("label", array_to_vector("fits").alias("features")))
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w]
    return RuleModel(kept, float(lasso.intercept))


def classify(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """All columns, ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5, else 0), which replace columns of these names; null texts count as empty."""
    scored = docs.withColumn("score", let(statistics(F.col(text)), model.score))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
