"""Operator 5: quality classifier as a sparse ensemble of rules.

1. Statistics of whole texts (``doc_stats``) are computed once per document.
2. A random forest of shallow trees is fitted on a bounded sample of labelled documents; every path
   from a root to a node is a conjunctive rule over the statistics.
3. A logistic regression with a lasso penalty weighs the rules; most weights become 0.
4. The remaining rules are compiled into one Spark column expression, which scores every document.

Labels are used only from documents that are not held out; labels, lang, source and doc_id are
no inputs.  The sample is bounded by ``max_rows`` labelled rows, picked by a hash of doc_id.

Nulls and edge cases: a null text has all statistics 0, as an empty one, and is scored like any other;
rows with a null label or doc_id teach nothing; a doc_id with several labels teaches with each; if the
sample holds fewer than two classes the score is the share of good labels (0.5 without labels).
Repeated rows get equal scores, an empty table an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import crc_rest, held_out, saved, table
from panelcast.llm.doc_stats import RATIOS, with_stats

FEATURES = (*RATIOS, "n_words", "n_lines")
MAX_ROWS, TREES, DEPTH, LASSO, THRESHOLD = 20_000, 40, 3, 0.002, 0.3


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, bound, above): above ? feature > bound : feature <= bound."""
    terms: tuple
    weight: float = 0.0

    def column(self) -> Column:
        out = F.lit(True)
        for i, (name, bound, above) in enumerate(self.terms):
            c = F.col(name) > bound if above else F.col(name) <= bound
            out = c if i == 0 else out & c
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple
    intercept: float

    def score(self) -> Column:
        """Probability of a good text as a column over the statistics."""
        total = F.lit(float(self.intercept))
        for r in self.rules:
            total = total + F.when(r.column(), float(r.weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def training_rows(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, label: str = "quality") -> DataFrame:
    """The statistics and label (double) of at most about ``max_rows`` documents that may teach."""
    teach = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).select("doc_id", F.col(label).cast("double").alias("label"))
    n, mod = teach.count(), 1 << 30
    picked = teach.where(crc_rest("doc_id", mod, "rules") < min(mod, int(mod * max_rows / max(1, n))))
    return picked.join(stats.select("doc_id", *[F.col(f).cast("double").alias(f) for f in FEATURES]), "doc_id")


def tree_rules(node, path: tuple = ()) -> list[tuple]:
    """Paths from the root to every node below it, as tuples of terms."""
    out = [path] if path else []
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, bound = FEATURES[split.featureIndex()], float(split.threshold())
        out += tree_rules(node.leftChild(), (*path, (name, bound, False)))
        out += tree_rules(node.rightChild(), (*path, (name, bound, True)))
    return out


def tightened(path: tuple) -> tuple:
    """One term per feature and side: the tightest bound."""
    best: dict = {}
    for name, bound, above in path:
        k = (name, above)
        best[k] = bound if k not in best else (max if above else min)(best[k], bound)
    return tuple((n, b, a) for (n, a), b in sorted(best.items()))


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 7) -> RuleEnsemble:
    """Fit the ensemble on ``train`` (FEATURES and label); its size is bounded by the caller."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    shares = train.agg(F.count("*").alias("n"), F.avg("label").alias("good")).first()
    if not shares["n"] or shares["good"] in (0.0, 1.0):
        import math

        good = min(max(0.5 if not shares["n"] else shares["good"], 1e-3), 1 - 1e-3)
        return RuleEnsemble((), math.log(good / (1 - good)))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, featureSubsetStrategy="onethird", minInstancesPerNode=5, subsamplingRate=0.5, seed=seed).fit(vectors)
    paths: dict = {}
    for tree in forest._java_obj.trees():
        for path in tree_rules(tree.rootNode()):
            paths.setdefault(tightened(path))
    rules = [Rule(p) for p in paths]
    hits = train.select("label", *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    hits = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(hits).select("label", "features")
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(hits)
    kept = tuple(Rule(r.terms, float(w)) for r, w in zip(rules, model.coefficients) if abs(w) > 1e-6)
    return RuleEnsemble(kept, float(model.intercept))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> tuple[DataFrame, RuleEnsemble]:
    """doc_id, score and predicted of every document, and the fitted ensemble."""
    stats = saved(with_stats(docs, keep=("doc_id",)), "rule-stats")
    model = fit(saved(training_rows(stats, labels, max_rows).coalesce(4), "rule-sample"))
    scored = stats.withColumn("score", model.score())
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted")), model


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` (all columns) that score at least ``threshold``.

    The labelled sample (at most about ``max_rows`` ids) is broadcast to fetch its texts; scoring is one
    pass in which the texts stay with their rows, so no text is shuffled."""
    teach = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).select("doc_id", "quality")
    n, mod = teach.count(), 1 << 30
    picked = teach.where(crc_rest("doc_id", mod, "rules") < min(mod, int(mod * max_rows / max(1, n)))).select("doc_id").distinct()
    sample = saved(with_stats(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), keep=("doc_id",)), "rule-stats")
    model = fit(saved(training_rows(sample, labels, max_rows).coalesce(4), "rule-sample"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_"))
    scored = with_stats(packed, keep=("row_",), inside=True).where(model.score() >= threshold)
    return scored.select(*[F.col("row_").getField(c).alias(c) for c in docs.columns])


def op5_rule_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and prediction of every document, learnt from ``labels``."""
    out, _ = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
