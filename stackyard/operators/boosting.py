"""Boosted trees with softmax, logistic or squared loss.

Every round fits one Spark ML regression tree for each score (several classes
have one score each) on the loss's residual over its curvature, weighted by the
curvature: a leaf is then the Newton step of its rows, and the variance split
is the split by Newton gain. The scores of all rows travel with the table, so a
round is its fits, one pass that adds the trees, and one aggregate with the
losses of the train and of the validation side. Rounds end when the validation
loss has not fallen for ``patience`` of them; the model is the best prefix.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackyard.session import cut_lineage

LOSSES = ("logistic", "softmax", "squared")
#: Rounds between reliable checkpoints of the table with its scores.
CHECKPOINT_ROUNDS = 5
FIT_THREADS = 4
LEAST_CURVATURE = 1e-9
EPS = 1e-15


@dataclass(frozen=True)
class Loss:
    """Scores, their Newton targets and the loss of one row, as expressions."""

    kind: str
    classes: int = 2

    @property
    def scores(self) -> int:
        return self.classes if self.kind == "softmax" else 1

    def start(self, df: DataFrame, label: str, weight: str | None) -> list[float]:
        """Scores of the best constant: the mean, its log odds, or log class shares."""
        import math

        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        y = F.col(label).cast("double")
        if self.kind != "softmax":
            mean = float(df.agg(F.sum(y * w) / F.sum(w)).first()[0] or 0.0)
            if self.kind == "squared":
                return [mean]
            mean = min(max(mean, EPS), 1 - EPS)
            return [math.log(mean / (1 - mean))]
        share = df.agg(F.sum(w), *[F.sum(F.when(y == k, w).otherwise(0.0)) for k in range(self.classes)]).first()
        return [math.log(max(float(s or 0) / max(float(share[0] or 0), EPS), EPS)) for s in share[1:]]

    def probabilities(self, scores: Column) -> Column:
        """Softmax of the scores, or [1 - p, p]."""
        if self.kind == "logistic":
            p = 1.0 / (1.0 + F.exp(-scores[0]))
            return F.array(1.0 - p, p)
        # class by class, not by lambdas: what stands in a lambda (the greatest
        # score, the total) is computed anew for every element of every row
        top = F.array_max(scores)
        e = [F.exp(scores[k] - top) for k in range(self.classes)]
        total = sum(e[1:], e[0])
        return F.array(*[x / total for x in e])

    def target(self, k: int, y: Column, prob: Column, scores: Column) -> tuple[Column, Column]:
        """(residual over curvature, curvature) of score ``k``."""
        if self.kind == "squared":
            return y - scores[0], F.lit(1.0)
        p = prob[1] if self.kind == "logistic" else prob[k]
        hit = y if self.kind == "logistic" else (y == k).cast("double")
        curve = F.greatest(p * (1.0 - p), F.lit(LEAST_CURVATURE))
        if self.kind == "softmax":  # the classes' scores move together
            curve = curve * (self.classes / (self.classes - 1))
        return (hit - p) / curve, curve

    def of_row(self, y: Column, prob: Column, scores: Column) -> Column:
        if self.kind == "squared":
            return (y - scores[0]) * (y - scores[0])
        own = F.when(y == 1, prob[1]).otherwise(prob[0]) if self.kind == "logistic" else F.element_at(prob, y.cast("int") + 1)
        return -F.log(F.greatest(F.least(own, F.lit(1 - EPS)), F.lit(EPS)))


def tree_sum(trees: list, rate: float) -> GBTRegressionModel:
    """Spark ML's own ensemble over fitted regression trees: one prediction column for all of them."""
    sc = trees[0]._sc if hasattr(trees[0], "_sc") else None
    from pyspark import SparkContext

    sc = sc or SparkContext._active_spark_context
    jvm, gateway = sc._jvm, sc._gateway
    array = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, t in enumerate(trees):
        array[i], weights[i] = t._java_obj, float(rate)
    java = jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"boost_{uuid.uuid4().hex[:12]}", array, weights)
    return GBTRegressionModel(java)


class BoostedModel(Model):
    """Rounds of trees; ``transform`` adds ``prediction`` and, for classes,
    ``probability``. ``curve`` has a row (round, train loss, validation loss) for
    each round fitted; ``best_round`` counts the rounds that are used."""

    def __init__(self, loss: Loss, start: list[float], rounds: list[list], rate: float, features: str,
                 curve: list[tuple], best_round: int):
        super().__init__()
        self.loss, self.start, self.rounds, self.rate, self.features = loss, start, rounds, rate, features
        self.curve, self.best_round = curve, best_round

    @property
    def best_score(self) -> float | None:
        """Validation loss of the best round (train loss without a validation side)."""
        row = self.curve[self.best_round]
        return row[2] if row[2] is not None else row[1]

    def prefix(self, rounds: int) -> "BoostedModel":
        """The same model cut to its first rounds."""
        return BoostedModel(self.loss, self.start, self.rounds, self.rate, self.features, self.curve, rounds)

    def with_scores(self, df: DataFrame, out: str = "__scores") -> DataFrame:
        used = self.rounds[:self.best_round]
        names = [f"__sum{k}" for k in range(self.loss.scores)]
        if used:
            for k, name in enumerate(names):
                part = tree_sum([r[k] for r in used], self.rate).setFeaturesCol(self.features).setPredictionCol(name)
                df = part.transform(df)
        total = [F.lit(s) + (F.col(n) if used else F.lit(0.0)) for s, n in zip(self.start, names)]
        return df.withColumn(out, F.array(*total)).drop(*names)

    def _transform(self, dataset):
        out = self.with_scores(dataset)
        if self.loss.kind == "squared":
            return out.withColumn("prediction", F.col("__scores")[0]).drop("__scores")
        out = out.withColumn("__p", self.loss.probabilities(F.col("__scores")))
        best = (F.array_position("__p", F.array_max("__p")) - 1).cast("double")
        return out.withColumn("probability", array_to_vector("__p")).withColumn("prediction", best).drop("__scores", "__p")


class BoostedTrees(Estimator):
    """Boosting by Newton steps.

    ``valid_col`` names a boolean column: its rows are not fitted but measured
    after every round. With ``patience`` the rounds end when their loss has not
    fallen for so many rounds, and the model uses the rounds up to its least
    loss. Rows need a label; labels of classes are 0, 1, ....
    """

    def __init__(self, loss: str, label: str = "label", features: str = "features", classes: int = 2, rounds: int = 10,
                 max_depth: int = 3, rate: float = 0.1, min_leaf: int = 1, subsample: float = 1.0, seed: int = 2017,
                 weight: str | None = None, valid_col: str | None = None, patience: int | None = None):
        super().__init__()
        if loss not in LOSSES:
            raise ValueError(loss)
        if patience is not None and not valid_col:
            raise ValueError("patience needs valid_col")
        self.loss = Loss(loss, classes)
        self.label, self.features, self.rounds, self.max_depth, self.rate = label, features, rounds, max_depth, rate
        self.min_leaf, self.subsample, self.seed, self.weight = min_leaf, subsample, seed, weight
        self.valid_col, self.patience = valid_col, patience

    def _trees(self, fit: DataFrame, round_: int) -> list:
        """One tree for each score, fitted side by side."""
        y, prob, scores = F.col("__y"), F.col("__prob"), F.col("__scores")
        src = fit.withColumn("__prob", self.loss.probabilities(scores)) if self.loss.kind != "squared" else fit

        def one(k: int):
            target, curve = self.loss.target(k, y, prob, scores)
            part = src.select(F.col(self.features).alias("x"), target.alias("t"), (curve * F.col("__w")).alias("c"))
            return DecisionTreeRegressor(featuresCol="x", labelCol="t", weightCol="c", maxDepth=self.max_depth,
                                         minInstancesPerNode=self.min_leaf, seed=self.seed + round_).fit(part)

        with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
            return list(pool.map(one, range(self.loss.scores)))

    def _losses(self, df: DataFrame) -> tuple[float | None, float | None]:
        """(train, validation) mean loss in one aggregate."""
        prob = self.loss.probabilities(F.col("__scores")) if self.loss.kind != "squared" else F.lit(None)
        rows = df.withColumn("__prob", prob)
        row = self.loss.of_row(F.col("__y"), F.col("__prob"), F.col("__scores")) * F.col("__w")
        rows = rows.select("__valid", "__w", row.alias("l"))
        sums = {r["__valid"]: r["l"] / r["w"] for r in rows.groupBy("__valid").agg(F.sum("l").alias("l"), F.sum("__w").alias("w")).collect() if r["w"]}
        return sums.get(False), sums.get(True)

    def _fit(self, dataset) -> BoostedModel:
        w = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        valid = F.coalesce(F.col(self.valid_col).cast("boolean"), F.lit(False)) if self.valid_col else F.lit(False)
        base = dataset.where(F.col(self.label).isNotNull()).select(
            self.features, F.col(self.label).cast("double").alias("__y"), w.alias("__w"), valid.alias("__valid"))
        start = self.loss.start(base.where(~F.col("__valid")), "__y", "__w")
        table = base.withColumn("__scores", F.array(*[F.lit(s) for s in start]))
        table = cut_lineage(table).persist()
        curve = [(0, *self._losses(table))]
        rounds: list[list] = []
        best = 0
        for r in range(1, self.rounds + 1):
            fit = table.where(~F.col("__valid"))
            fit = fit.sample(False, self.subsample, self.seed + r) if self.subsample < 1 else fit
            trees = self._trees(fit, r)
            rounds.append(trees)
            nxt = table
            for k, t in enumerate(trees):
                nxt = t.setFeaturesCol(self.features).setPredictionCol(f"__t{k}").transform(nxt)
            moved = [F.col("__scores")[k] + self.rate * F.col(f"__t{k}") for k in range(len(trees))]
            nxt = nxt.withColumn("__scores", F.array(*moved)).drop(*[f"__t{k}" for k in range(len(trees))])
            nxt = cut_lineage(nxt) if r % CHECKPOINT_ROUNDS == 0 else nxt
            nxt = nxt.persist()
            curve.append((r, *self._losses(nxt)))
            table.unpersist()
            table = nxt
            if self.valid_col is None:
                best = r
                continue
            if curve[r][2] is not None and curve[r][2] < curve[best][2]:
                best = r
            if self.patience is not None and r - best >= self.patience:
                break
        table.unpersist()
        if self.valid_col is not None and self.patience is None:
            best = len(rounds)  # measured only
        return BoostedModel(self.loss, start, rounds, self.rate, self.features, curve, best)


def curve_table(spark, model: BoostedModel) -> DataFrame:
    """(round, train_loss, valid_loss, is_best) of every round fitted."""
    rows = [(int(r), t, v, r == model.best_round) for r, t, v in model.curve]
    return spark.createDataFrame(rows, "round int, train_loss double, valid_loss double, is_best boolean")


def staged_losses(model: BoostedModel, df: DataFrame, label: str = "label") -> DataFrame:
    """(round, loss) of every prefix on other rows, from one pass: each row's
    trees are added up round by round inside it, and one aggregate takes the
    mean of every round's loss."""
    loss, n = model.loss, len(model.rounds)
    for r, trees in enumerate(model.rounds):
        for k, t in enumerate(trees):
            df = t.setFeaturesCol(model.features).setPredictionCol(f"__t{r}_{k}").transform(df)
    y = F.col(label).cast("double")
    start = F.array(*[F.lit(s) for s in model.start])
    exprs, running = [], start
    df = df.where(F.col(label).isNotNull()).withColumn("__s0", running)
    for r in range(n):
        prev = F.col(f"__s{r}")
        df = df.withColumn(f"__s{r + 1}", F.array(*[prev[k] + model.rate * F.col(f"__t{r}_{k}") for k in range(loss.scores)]))
    for r in range(n + 1):
        s = F.col(f"__s{r}")
        prob = loss.probabilities(s) if loss.kind != "squared" else F.lit(None)
        exprs.append(F.avg(loss.of_row(y, prob, s)).alias(f"r{r}"))
    parts = ", ".join(f"{r}, r{r}" for r in range(n + 1))
    return df.agg(*exprs).selectExpr(f"stack({n + 1}, {parts}) AS (round, loss)")


def cross_validated_rounds(df: DataFrame, kind: str, folds: int, fold_col: str = "fold", **params) -> DataFrame:
    """Boosted rounds cross-validated. Each fold's rows are the validation
    side of a fit on the others; a row for each fold: its best round and its
    train and validation loss there, and the losses at the common best round
    (the least mean validation loss over the rounds that all folds reached)."""
    from stackyard.operators.models import estimator

    def one(k: int) -> BoostedModel:
        return estimator(kind, valid_col="__out", **params).fit(df.withColumn("__out", F.col(fold_col) == k))

    with ThreadPoolExecutor(max_workers=2) as pool:
        models = list(pool.map(one, range(folds)))
    shared = min(len(m.curve) for m in models)
    means = [sum(m.curve[r][2] for m in models) / folds for r in range(shared)]
    common = min(range(shared), key=lambda r: (means[r], r))
    rows = [(k, m.best_round, m.curve[m.best_round][1], m.curve[m.best_round][2], common, m.curve[common][1], m.curve[common][2])
            for k, m in enumerate(models)]
    return df.sparkSession.createDataFrame(
        rows, "fold int, best_round int, train_loss double, cv_loss double, common_round int, "
              "common_train_loss double, common_cv_loss double")
