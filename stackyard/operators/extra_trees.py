"""Extra trees (T3): trees with random thresholds.

Each tree draws its own cut points for every feature, uniform between the
feature's least and greatest value; rows become bin numbers, and a Spark ML tree
grown on the bins takes the best of the drawn cuts at each node, for a random
subset of the features. No bootstrap: every tree sees all rows.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackyard.operators.boosting import tree_sum

FIT_THREADS = 4


def drawn_cuts(low: list[float], high: list[float], cuts: int, seed: int) -> list[list[float]]:
    """Sorted random thresholds of every feature, from the seed alone. A feature
    without spread has none."""
    rnd = random.Random(seed)
    return [sorted(rnd.uniform(a, b) for _ in range(cuts)) if b > a else [] for a, b in zip(low, high)]


def binned(df: DataFrame, values: str, cuts: list[list[float]], out: str) -> DataFrame:
    """Add the vector of each value's number of cuts below it. ``values`` is an
    array column. ``Bucketizer`` finds them by binary search; it puts a value
    that equals a split above it, so the splits are the next doubles after the
    cuts, and not-a-number, its bucket of its own, is above all cuts."""
    inputs, outputs, splits, parts = {}, [], [], []
    for i, own in enumerate(cuts):
        if not own:
            parts.append(F.lit(0.0))
            continue
        steps = sorted({math.nextafter(c, math.inf) for c in own})
        inputs[f"__x{i}"] = F.col(values)[i]
        outputs.append(f"__n{i}")
        splits.append([-math.inf, *steps, math.inf])
        number = F.least(F.col(f"__n{i}"), F.lit(float(len(steps))))
        if len(steps) < len(own):  # a cut drawn more than once counts as often
            below = [0.0, *[float(sum(c < s for c in own)) for s in steps]]
            number = F.element_at(F.array(*[F.lit(b) for b in below]), number.cast("int") + 1)
        parts.append(number)
    if inputs:
        df = Bucketizer(splitsArray=splits, inputCols=list(inputs), outputCols=outputs, handleInvalid="keep").transform(df.withColumns(inputs))
    return df.withColumn(out, array_to_vector(F.array(*parts))).drop(*inputs, *outputs)


class ExtraTreesModel(Model):
    """Trees with their cut points; ``transform`` adds ``prediction``, and for
    classes ``probability``. ``parts`` has one list of (cuts, tree) for each
    class, or one list alone."""

    def __init__(self, parts: list[list[tuple]], features: str, regression: bool):
        super().__init__()
        self.parts, self.features, self.regression = parts, features, regression

    def thresholds(self) -> list[list[list[float]]]:
        """The cut points of every tree (trees x features x cuts)."""
        return [cuts for part in self.parts for cuts, _ in part]

    def _means(self, df: DataFrame) -> tuple[DataFrame, list[Column]]:
        """The trees' mean for each part; a cut table shared by all parts is binned once."""
        out, temp = df.withColumn("__v", vector_to_array(self.features)), ["__v"]
        n = len(self.parts[0])
        for t in range(n):
            name = f"__b{t}"
            out = binned(out, "__v", self.parts[0][t][0], name)
            temp.append(name)
            for p, part in enumerate(self.parts):
                score = f"__p{p}_{t}"
                out = part[t][1].setFeaturesCol(name).setPredictionCol(score).transform(out)
                temp.append(score)
        means = [sum((F.col(f"__p{p}_{t}") for t in range(n)), F.lit(0.0)) / n for p in range(len(self.parts))]
        out = out.withColumn("__m", F.array(*means)).drop(*temp)
        return out, [F.col("__m")[p] for p in range(len(self.parts))]

    def _transform(self, dataset):
        out, means = self._means(dataset)
        if self.regression:
            return out.withColumn("prediction", means[0]).drop("__m")
        if len(means) == 1:
            p = F.array(1.0 - means[0], means[0])
        else:
            total = sum(means[1:], means[0])
            p = F.array(*[F.when(total > 0, m / total).otherwise(1.0 / len(means)) for m in means])
        out = out.withColumn("__q", p).drop("__m")
        best = (F.array_position("__q", F.array_max("__q")) - 1).cast("double")
        return out.withColumn("probability", array_to_vector("__q")).withColumn("prediction", best).drop("__q")


class ExtraTrees(Estimator):
    """``trees`` trees with ``cuts`` random thresholds for each feature and tree.
    Classes above two have one tree for each class and cut table."""

    def __init__(self, label: str = "label", features: str = "features", trees: int = 10, max_depth: int = 8, cuts: int = 16,
                 max_features: str = "sqrt", min_leaf: int = 1, classes: int = 2, regression: bool = False, seed: int = 2017,
                 weight: str | None = None):
        super().__init__()
        self.label, self.features, self.trees, self.max_depth, self.cuts = label, features, trees, max_depth, cuts
        self.max_features, self.min_leaf, self.classes, self.regression = max_features, min_leaf, classes, regression
        self.seed, self.weight = seed, weight

    def _fit(self, dataset) -> ExtraTreesModel:
        w = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        y = F.col(self.label).cast("double")
        src = dataset.where(F.col(self.label).isNotNull()).select(F.col(self.features).alias("x"), y.alias("y"), w.alias("w")).persist()
        got = src.agg(Summarizer.min(F.col("x")).alias("lo"), Summarizer.max(F.col("x")).alias("hi")).first()
        low, high = got["lo"].toArray().tolist(), got["hi"].toArray().tolist()
        tables = [drawn_cuts(low, high, self.cuts, self.seed * 1_000_003 + t) for t in range(self.trees)]
        classes = range(self.classes) if self.classes > 2 and not self.regression else [None]

        def one(job):
            t, k = job
            label = F.col("y") if k is None else (F.col("y") == k).cast("double")
            rows = binned(src.withColumn("__v", vector_to_array("x")), "__v", tables[t], "b").select("b", label.alias("y"), "w")
            forest = RandomForestRegressor(featuresCol="b", labelCol="y", weightCol="w", numTrees=1, bootstrap=False,
                                           maxDepth=self.max_depth, maxBins=max(self.cuts + 1, 2), minInstancesPerNode=self.min_leaf,
                                           featureSubsetStrategy=self.max_features, seed=self.seed + 7919 * t)
            return tree_sum([forest.fit(rows).trees[0]], 1.0)

        jobs = [(t, k) for k in classes for t in range(self.trees)]
        with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
            fitted = list(pool.map(one, jobs))
        src.unpersist()
        parts = [[(tables[t], fitted[i * self.trees + t]) for t in range(self.trees)] for i in range(len(classes))]
        return ExtraTreesModel(parts, self.features, self.regression)
