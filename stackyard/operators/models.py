"""Model boundary (T1-T11, B6, B7, F19, X4, X6): Spark ML estimators on
an assembled feature vector. Fits are distributed by Spark ML; the driver
only loops over folds, labels, seeds or parameter points."""

from __future__ import annotations

import itertools
import math
import random
import re
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackyard.operators.boosting import BoostedTrees
from stackyard.operators.extra_trees import ExtraTrees
from stackyard.operators.metrics import log_loss

BOOST_PARAMS = ("classes", "rounds", "rate", "min_leaf", "subsample", "valid_col", "patience")
MAX_TREE_DEPTH = 30  # Spark ML limit; deeper settings are refused


class ProbabilityModel(Model):
    """Class shares of regression trees as a ``probability`` vector."""

    def __init__(self, parts: list):
        super().__init__()
        self.parts = parts  # one regressor of the 0/1 label, or one for each class

    @property
    def featureImportances(self):
        return self.parts[0].featureImportances

    def _transform(self, dataset):
        out, shares = dataset, []
        for k, part in enumerate(self.parts):
            name = f"__share{k}"
            out = part.setPredictionCol(name).transform(out)
            shares.append(F.col(name))
        if len(shares) == 1:
            p = F.array(1.0 - shares[0], shares[0])
        else:
            total = sum(shares[1:], shares[0])
            p = F.array(*[F.when(total > 0, s / total).otherwise(1.0 / len(shares)) for s in shares])
        return (out.withColumn("probability", array_to_vector(p))
                .withColumn("prediction", (F.array_position(p, F.array_max(p)) - 1).cast("double"))
                .drop(*[f"__share{k}" for k in range(len(shares))]))


class _ClassShares:
    """Fits on the 0/1 label (variance splits are the gini splits), so a leaf
    predicts the share of its class. Spark ML's tree classifiers merge sibling
    leaves with the same predicted class, which loses their shares. With
    ``classes`` above 2 one tree or forest is fitted for each class."""

    classes = 2

    def _fit(self, dataset):
        label = self.getLabelCol()
        if self.classes <= 2:
            return ProbabilityModel([super()._fit(dataset)])
        parts = []
        for k in range(self.classes):
            own = dataset.withColumn("__class", (F.col(label) == k).cast("double"))
            parts.append(self.copy({self.labelCol: "__class"}).fit_class(own))
        return ProbabilityModel(parts)

    def fit_class(self, dataset):
        return super()._fit(dataset)


class ShareTree(_ClassShares, DecisionTreeRegressor):
    pass


class ShareForest(_ClassShares, RandomForestRegressor):
    pass


def assemble(df: DataFrame, cols: list[str], out: str = "features", fill: float | None = -999.0) -> DataFrame:
    """Feature vector at the model boundary; nulls are filled first (trees
    in Spark ML do not take NaN)."""
    src = df.fillna(fill, subset=cols) if fill is not None else df
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(src)


def estimator(kind: str, label: str = "label", features: str = "features", seed: int = 2017,
              weight: str | None = None, **kw) -> Estimator:
    """Named estimators. ``extra_trees`` draws random thresholds for every tree
    (:mod:`stackyard.operators.extra_trees`); ``boost``, ``softmax_boost`` and
    ``boost_reg`` boost by Newton steps, with a validation column and patience
    (:mod:`stackyard.operators.boosting`); ``gbt`` and ``gbt_reg`` are Spark ML's.
    ``criterion='entropy'`` needs Spark ML's classifiers, whose merged leaves
    (see :class:`_ClassShares`) make its probabilities coarser."""
    depth = int(kw.pop("max_depth", 5))
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {depth}: Spark ML grows trees of at most {MAX_TREE_DEPTH} levels")
    common = dict(labelCol=label, featuresCol=features)
    if weight:
        common["weightCol"] = weight
    if kind in ("boost", "softmax_boost", "boost_reg"):
        loss = {"boost": "logistic", "softmax_boost": "softmax", "boost_reg": "squared"}[kind]
        return BoostedTrees(loss, label, features, max_depth=depth, seed=seed, weight=weight,
                            **{k: kw[k] for k in BOOST_PARAMS if k in kw})
    if kind in ("extra_trees", "extra_trees_reg"):
        reg = kind == "extra_trees_reg"
        return ExtraTrees(label, features, trees=kw.get("trees", 20), max_depth=depth, cuts=kw.get("cuts", 16),
                          max_features=kw.get("max_features", "onethird" if reg else "sqrt"), min_leaf=kw.get("min_leaf", 1),
                          classes=kw.get("classes", 2), regression=reg, seed=seed, weight=weight)
    if kind in ("tree", "forest") and kw.get("criterion", "gini") != "entropy":
        if kind == "tree":
            out = ShareTree(maxDepth=depth, minInstancesPerNode=kw.get("min_leaf", 1), seed=seed, **common)
        else:
            out = ShareForest(numTrees=kw.get("trees", 20), maxDepth=depth,
                              featureSubsetStrategy=kw.get("max_features", "sqrt"),
                              minInstancesPerNode=kw.get("min_leaf", 1), bootstrap=kw.get("bootstrap", True),
                              seed=seed, **common)
        out.classes = kw.get("classes", 2)
        return out
    if kind == "tree":
        return DecisionTreeClassifier(impurity="entropy", maxDepth=depth,
                                      minInstancesPerNode=kw.get("min_leaf", 1), seed=seed, **common)
    if kind == "forest":
        return RandomForestClassifier(numTrees=kw.get("trees", 20), maxDepth=depth,
                                      impurity="entropy",
                                      featureSubsetStrategy=kw.get("max_features", "sqrt"),
                                      minInstancesPerNode=kw.get("min_leaf", 1), seed=seed, **common)
    if kind == "gbt":
        return GBTClassifier(maxIter=kw.get("rounds", 10), maxDepth=depth, stepSize=kw.get("rate", 0.1),
                             subsamplingRate=kw.get("subsample", 1.0), seed=seed, **common,
                             **({"validationIndicatorCol": kw["valid_col"]} if kw.get("valid_col") else {}))
    if kind == "logistic":
        if "n_rows" not in kw:
            raise ValueError("logistic: n_rows (rows of the fit) sets the penalty 1 / (C * n_rows)")
        return LogisticRegression(regParam=1.0 / (kw.get("C", 1.0) * kw["n_rows"]), elasticNetParam=0.0, standardization=False,
                                  maxIter=kw.get("max_iter", 100), tol=kw.get("tol", 1e-6), **common)
    if kind == "bernoulli_nb":
        return NaiveBayes(modelType="bernoulli", smoothing=kw.get("alpha", 1.0), **common)
    if kind == "forest_reg":
        return RandomForestRegressor(numTrees=kw.get("trees", 20), maxDepth=depth,
                                     featureSubsetStrategy=kw.get("max_features", "onethird"),
                                     minInstancesPerNode=kw.get("min_leaf", 1), bootstrap=kw.get("bootstrap", True),
                                     seed=seed, **common)
    if kind == "gbt_reg":
        return GBTRegressor(maxIter=kw.get("rounds", 10), maxDepth=depth, stepSize=kw.get("rate", 0.1),
                            seed=seed, **common)
    if kind == "linear":
        return LinearRegression(fitIntercept=kw.get("intercept", True), regParam=kw.get("reg", 0.0), **common)
    raise ValueError(kind)


def positive_probability(df: DataFrame, out: str = "pred", prob: str = "probability") -> DataFrame:
    """P(class 1) from the probability vector."""
    return df.withColumn(out, vector_to_array(F.col(prob))[1])


def class_probabilities(df: DataFrame, n_class: int, prefix: str = "p_", prob: str = "probability",
                        offset: int = 0) -> DataFrame:
    arr = vector_to_array(F.col(prob))
    return df.select("*", *[arr[i].alias(f"{prefix}{i + offset}") for i in range(n_class)])


def predict(model, df: DataFrame, out: str = "pred", regression: bool = False) -> DataFrame:
    """One new column; models can be applied one after another to the same rows."""
    res = model.transform(df)
    res = res.withColumnRenamed("prediction", out) if regression else positive_probability(res, out)
    return res.drop("rawPrediction", "probability", "prediction")


def mean_prediction(models: list, df: DataFrame, out: str = "pred", regression: bool = False) -> DataFrame:
    """The mean of several models' predictions, row by row."""
    names = [f"__{out}_{i}" for i in range(len(models))]
    for m, n in zip(models, names):
        df = predict(m, df, n, regression)
    return df.withColumn(out, sum(F.col(n) for n in names) / len(names)).drop(*names)


def fold_prediction(models: list, df: DataFrame, fold_col: str, out: str = "pred",
                    regression: bool = False) -> DataFrame:
    """Each row's prediction by the model of its fold (the one that did not see it)."""
    names = [f"__{out}_{i}" for i in range(len(models))]
    for m, n in zip(models, names):
        df = predict(m, df, n, regression)
    own = F.element_at(F.array(*names), F.col(fold_col).cast("int") + 1)
    return df.withColumn(out, own).drop(*names)


class LogLossEvaluator(Evaluator):
    """Log loss of P(class 1) (smaller is better)."""

    def __init__(self, label: str = "label", prob: str = "probability"):
        super().__init__()
        self.label, self.prob = label, prob

    def _evaluate(self, dataset):
        d = dataset.withColumn("__p", vector_to_array(F.col(self.prob))[1])
        return log_loss(d, self.label, "__p").first()[0]

    def isLargerBetter(self):
        return False


# ------------------------------------------------------------ cross-validation and sweeps

SWEEP_THREADS = 4
#: Names whose capitals label a model in the log.
LOG_NAMES = {"tree": "DecisionTreeClassifier", "forest": "RandomForestClassifier", "extra_trees": "ExtraTreesClassifier",
             "gbt": "GradientBoostedClassifier", "boost": "BoostedTreesClassifier", "logistic": "LogisticRegression",
             "bernoulli_nb": "BernoulliNaiveBayes"}
BOOSTED = ("boost", "gbt")
#: The log row of one cross-validated point.
LOG_SCHEMA = ("model string, rounds int, criterion string, depth int, weight int, features string, subsample double, "
              "bootstrap boolean, rate double, best_round_mean double, best_round_max int, cv_loss double, cv_std double, "
              "train_loss double, train_std double, seconds double, folds int, shape array<bigint>, options array<string>")


@dataclass(frozen=True)
class FoldResult:
    fold: int
    train_loss: float
    cv_loss: float
    best_round: int
    seconds: float


def _fold_result(df: DataFrame, kind: str, k: int, label: str, fold_col: str, stages: list, features: list[str] | None,
                 params: dict) -> FoldResult:
    """One fit without fold ``k``. Feature stages are fitted on the same rows
    (X7), so they never see the fold's labels; a boosted model with patience
    is measured on the fold and scores with its best rounds. Both losses come
    from one aggregate."""
    t0 = time.time()
    out = F.col(fold_col) == k
    rows = df
    if stages:
        last = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")] if features else []
        rows = Pipeline(stages=[*stages, *last]).fit(df.where(~out)).transform(df)
    elif features:
        rows = assemble(df, features)
    if params.get("patience"):
        model = estimator(kind, label, valid_col="__out", **params).fit(rows.withColumn("__out", out))
    else:
        model = estimator(kind, label, **params).fit(rows.where(~out))
    scored = predict(model, rows).withColumn("__out", out)
    loss = {r["__out"]: r["logloss"] for r in log_loss(scored, label, "pred", by=["__out"]).collect()}
    best = model.best_round if params.get("patience") else 0
    return FoldResult(k, float(loss[False]), float(loss[True]), best, time.time() - t0)


def _queue(df: DataFrame, jobs: list[tuple], label: str, fold_col: str, stages: list, features: list[str] | None) -> list[FoldResult]:
    """All (model, parameters, fold) fits from one queue over one cached
    table; results keep the jobs' order, whatever order they end in."""
    # without feature stages a fit reads the vector, the label and the fold alone
    base = (df if stages or features else df.select(label, fold_col, "features")).persist()
    try:
        with ThreadPoolExecutor(max_workers=SWEEP_THREADS) as pool:
            return list(pool.map(lambda j: _fold_result(base, j[0], j[2], label, fold_col, stages, features, j[1]), jobs))
    finally:
        base.unpersist()


def cv_score(df: DataFrame, kind: str, folds: int, label: str = "label", fold_col: str = "fold",
             stages: list | None = None, features: list[str] | None = None, **params) -> DataFrame:
    """Per-fold train and validation log loss of one model and its best
    round (0 without ``patience``). ``stages`` are feature estimators (X7) that
    are fitted inside each fold, in a pipeline that ends with an assembler of the
    columns ``features`` (without them a stage makes the vector)."""
    got = _queue(df, [(kind, params, k) for k in range(folds)], label, fold_col, stages or [], features)
    return df.sparkSession.createDataFrame([astuple(r) for r in got], "fold int, train_loss double, cv_loss double, best_round int, seconds double")


def grid_points(kinds: list[str], grid: dict[str, list], own: dict[str, dict] | None = None) -> list[tuple[str, dict]]:
    """Every (model, parameters) of a grid, models within points; ``own`` has each model's fixed parameters."""
    names = list(grid)
    return [(kind, {**(own or {}).get(kind, {}), **dict(zip(names, point))})
            for point in itertools.product(*[grid[n] for n in names]) for kind in kinds]


def log_rows(points: list[tuple[str, dict]], results: list[list[FoldResult]], folds: int, shape: tuple[int, int],
             options: list[str]) -> list[tuple]:
    """The 19 fields of each point's log row. What a model does not have is null."""
    rows = []
    for (kind, params), got in zip(points, results):
        boosted, trees = kind in BOOSTED, kind in ("forest", "extra_trees")
        cv, train, best = ([getattr(r, f) for r in got] for f in ("cv_loss", "train_loss", "best_round"))
        mean = lambda v: sum(v) / len(v)
        std = lambda v: math.sqrt(mean([(x - mean(v)) ** 2 for x in v]))
        rows.append((
            re.sub("[^A-Z]", "", LOG_NAMES.get(kind, kind.title())), params.get("rounds" if boosted else "trees"),
            "logistic" if boosted else params.get("criterion", "gini") if kind in ("tree", "forest", "extra_trees") else None,
            params.get("max_depth"), params.get("min_leaf"), str(params["max_features"]) if "max_features" in params else None,
            float(params.get("subsample", 1.0)) if boosted else None, params.get("bootstrap", True) if kind == "forest" else False if trees else None,
            float(params["rate"]) if boosted and "rate" in params else None, mean(best), max(best),
            mean(cv), std(cv), mean(train), std(train), sum(r.seconds for r in got), folds, list(shape), options))
    return rows


def grid_sweep(df: DataFrame, points: list[tuple[str, dict]], folds: int, label: str = "label", fold_col: str = "fold",
               features: list[str] | None = None, stages: list | None = None) -> DataFrame:
    """Every (model, parameters) point cross-validated, a log row each
    (``LOG_SCHEMA``), in the order of the points. All fits of the sweep share one
    queue and one cached table."""
    jobs = [(kind, params, k) for kind, params in points for k in range(folds)]
    got = _queue(df, jobs, label, fold_col, stages or [], features)
    results = [got[i * folds:(i + 1) * folds] for i in range(len(points))]
    width = len(features) if features else len(df.columns)
    options = [type(s).__name__ for s in stages or []]
    return df.sparkSession.createDataFrame(log_rows(points, results, folds, (df.count(), width), options), LOG_SCHEMA)


def random_points(bounds: dict[str, tuple], trials: int, seed: int) -> list[dict]:
    """Seeded random points: integers between integer bounds, else floats."""
    rnd = random.Random(seed)
    draw = lambda lo, hi: rnd.randint(lo, hi) if isinstance(lo, int) and isinstance(hi, int) else rnd.uniform(lo, hi)
    return [{k: draw(lo, hi) for k, (lo, hi) in bounds.items()} for _ in range(trials)]


def random_search(df: DataFrame, kind: str, bounds: dict, trials: int, seed: int, label: str = "label",
                  holdout_col: str = "is_fit") -> DataFrame:
    """T11 (re-aimed from a Gaussian-process optimiser): seeded random
    points inside ``bounds``; score = -log loss on the holdout. The trials share
    one queue and one cached table."""
    points = random_points(bounds, trials, seed)
    base = df.persist()

    def one(params: dict) -> tuple:
        model = estimator(kind, label, **params).fit(base.where(F.col(holdout_col)))
        loss = log_loss(predict(model, base.where(~F.col(holdout_col))), label, "pred").first()[0]
        return {k: float(v) for k, v in params.items()}, -float(loss)

    try:
        with ThreadPoolExecutor(max_workers=SWEEP_THREADS) as pool:
            rows = list(pool.map(one, points))
    finally:
        base.unpersist()
    return df.sparkSession.createDataFrame(rows, "params map<string,double>, score double")


def gated(scores: DataFrame, loss: float, limit: float) -> DataFrame:
    """Output only when the validation loss is under ``limit``."""
    return scores if loss < limit else scores.limit(0)


def platt_calibrate(fit_scores: DataFrame, apply_scores: DataFrame, label: str = "label",
                    score: str = "pred", out: str = "calibrated") -> DataFrame:
    """Logistic regression of the label on a held-out raw score."""
    a = VectorAssembler(inputCols=[score], outputCol="__s").transform(fit_scores)
    lr = LogisticRegression(featuresCol="__s", labelCol=label, regParam=0.0, tol=1e-12, maxIter=200).fit(a)
    b = VectorAssembler(inputCols=[score], outputCol="__s").transform(apply_scores)
    res = lr.transform(b)
    return positive_probability(res, out).drop("__s", "rawPrediction", "probability", "prediction")


def polynomial(df: DataFrame, cols: list[str], degree: int = 2, out: str = "poly") -> DataFrame:
    """degree-n polynomial expansion of the listed columns."""
    a = assemble(df, cols, "__v", fill=0.0)
    return PolynomialExpansion(degree=degree, inputCol="__v", outputCol=out).transform(a).drop("__v")


def feature_importances(model, names: list[str]) -> list[tuple[str, float]]:
    """L3 report: importance per feature name, largest first."""
    imp = model.featureImportances.toArray()
    return sorted(zip(names, map(float, imp)), key=lambda t: (-t[1], t[0]))
