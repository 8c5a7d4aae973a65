"""Gradient-boosted trees fitted by Spark ML and read back as column expressions.

Scoring is then plain arithmetic inside code generation: no vector column, no
Python, and no output columns that could clash with the caller's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES, DEPTH = 20, 3


@dataclass
class Boosted:
    """Trees as nested tuples (feature, threshold, left, right) or leaf values, with weights."""

    trees: list[tuple[float, object]]
    knots: list[tuple[float, float]]      # isotonic: raw score, calibrated score
    base: float                           # the score where there was nothing to learn

    def raw(self, features: list[Column]) -> Column:
        """The uncalibrated chance of label 1."""
        def grown(node):
            if not isinstance(node, tuple):
                return F.lit(float(node))
            f, cut, left, right = node
            return F.when(features[f] <= F.lit(cut), grown(left)).otherwise(grown(right))

        if not self.trees:
            return F.lit(self.base)
        margin = sum((F.lit(w) * grown(t) for w, t in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def score(self, raw: Column) -> Column:
        """Calibrated: linear between the knots. A thousandth of the raw score breaks ties.

        The raw score is bound once, in a lambda, however often it is used.
        """
        if not self.knots:
            return raw
        n = len(self.knots)
        xs, ys = (F.array(*[F.lit(float(k[i])) for k in self.knots]) for i in (0, 1))

        def calibrated(r: Column) -> Column:
            below = F.size(F.filter(xs, lambda x: x <= r))
            i, j = F.greatest(below, F.lit(1)), F.least(below + 1, F.lit(n))
            x0, x1, y0, y1 = (F.element_at(v, k) for v in (xs, ys) for k in (i, j))
            part = F.when(x1 > x0, F.greatest(F.lit(0.0), (r - x0) / F.nullif(x1 - x0, F.lit(0.0)))).otherwise(0.0)
            return 0.999 * (y0 + (y1 - y0) * part) + 0.001 * r

        return F.transform(F.array(raw), calibrated)[0]


def fit(rows: DataFrame, size: int, trees: int = TREES, depth: int = DEPTH) -> Boosted:
    """Fit on rows with features (array of ``size`` doubles), label and ``calibrate``.

    Rows with ``calibrate`` only serve the isotonic calibration. With one label
    alone there is nothing to learn: the score is that label's value, or 0
    without any row.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    seen = {(r.label, r.calibrate) for r in rows.select("label", "calibrate").distinct().collect()}
    labels = {label for label, calibrate in seen if not calibrate}
    if len(labels) < 2:
        return Boosted([], [], float(max(labels, default=0.0)))
    vectors = rows.select(array_to_vector("features").alias("features"),
                          F.col("label").cast("double").alias("label"), "calibrate")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, maxBins=64, subsamplingRate=1.0,
                          stepSize=0.2, minInstancesPerNode=5).fit(vectors.filter("not calibrate"))

    def read(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return node.prediction()
        split = node.split()
        return split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild())

    grown = [(w, read(t._call_java("rootNode"))) for w, t in
             zip(model.treeWeights, model.trees, strict=True)]
    boosted = Boosted(grown, [], 0.0)
    held = (rows.filter("calibrate")
            .select(boosted.raw([F.col("features")[i] for i in range(size)]).alias("raw"),
                    F.col("label").cast("double").alias("label")))
    if {label for label, calibrate in seen if calibrate} == labels:
        # Rows of one score count as one with their weight: few distinct scores, however many rows.
        scores = held.groupBy("raw").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
        isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(scores)
        boosted.knots = list(zip(isotonic.boundaries.toArray().tolist(),
                                 isotonic.predictions.toArray().tolist(), strict=True))
    return boosted
