"""Out-of-fold stacking (K1-K9), logit features (E18-E19), greedy linear
feature groups (L4) and selection by importance / chi² (L2, L3).

Predictions are a long table ``(id, model, pred)`` or new columns of the
keyed table; a row's out-of-fold prediction comes from the model that did
not see its fold. The fold loop runs on the driver; each fit is a Spark ML
job. The base table is checkpointed into ``spark.checkpoint.dir`` when the
cluster names one, so a lost executor recomputes from there.
"""

from __future__ import annotations

import math
import operator
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Model
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackyard.operators.folds import ordinal_cut_folds, positional_holdout
from stackyard.operators.models import assemble, estimator, fold_prediction, mean_prediction, predict
from stackyard.operators.moments import sums_of_products
from stackyard.session import checkpoint_dir, cut_lineage


FIT_THREADS = 4  # independent fits submitted as concurrent Spark jobs
LOSS_BATCH = 100  # losses of linear groups in one aggregate


def fit_parallel(jobs, params: dict):
    """Fit independent models concurrently (one Spark job stream each, like
    ``CrossValidator(parallelism=...)``); results keep the job order. A job is
    (kind, label, rows) and, where it has some of its own, parameters."""
    def one(job):
        kind, label, rows, *own = job
        return estimator(kind, label, **{**params, **(own[0] if own else {})}).fit(rows)

    with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
        return list(pool.map(one, jobs))


def kept(rows: DataFrame) -> DataFrame:
    """Rows that several fits or scores read, worked out once: from the shared
    checkpoint folder if there is one, else kept in memory."""
    return cut_lineage(rows) if checkpoint_dir(rows.sparkSession) else rows.persist()


def _prepare(df: DataFrame, features: list[str]) -> DataFrame:
    """The assembled rows, kept."""
    return kept(assemble(df, features))


def _with_rows(kind: str, params: dict, tr: DataFrame) -> dict:
    """The penalty of a logistic regression depends on the rows of its fit."""
    return {"n_rows": tr.count(), **params} if kind == "logistic" else params


def _fold_jobs(tr: DataFrame, kind: str, label: str, folds: int, fold_col: str, refit: bool) -> list:
    """Fits of one model: one without each fold, then one on all rows."""
    jobs = [(kind, label, tr.where(F.col(fold_col) != k)) for k in range(folds)]
    return jobs + [(kind, label, tr)] if refit else jobs


def oof_predict(train: DataFrame, test: DataFrame | None, features: list[str], label: str, kind: str,
                folds: int, fold_col: str = "fold", key: str = "id", name: str = "pred",
                test_mode: str = "refit", regression: bool = False, **params) -> DataFrame:
    """K1/K3/K4: out-of-fold predictions for train rows and test-side
    predictions, either by a refit on all train rows (``refit``) or as the
    mean of the fold models (``mean``). Returns ``(id, name)``. The fitted
    models are applied one after another to the same rows: no join, no shuffle."""
    tr = _prepare(train, features)
    params = _with_rows(kind, params, tr)
    refit = test is not None and test_mode != "mean"
    fitted = fit_parallel(_fold_jobs(tr, kind, label, folds, fold_col, refit), params)
    out = fold_prediction(fitted[:folds], tr, fold_col, name, regression).select(key, name)
    if test is not None:
        te = assemble(test, features)
        scored = (predict(fitted[folds], te, name, regression) if refit
                  else mean_prediction(fitted, te, name, regression))
        out = out.unionByName(scored.select(key, name))
    return out


def oof_bumps(train: DataFrame, test: DataFrame, features: list[str], y: str, n_class: int, kind: str,
              folds: int, key: str = "id", **params) -> DataFrame:
    """K1: one binary model per ordinal cut ``y <= k+1`` (k = 0..n_class-2),
    out of fold on train, refit on all train for test; wide
    ``(id, bump_0..)``. Every cut has folds of its own, stratified by its side
    of the cut. All cuts' models are applied to the same rows."""
    labs = [f"__lab{k}" for k in range(n_class - 1)]
    train = ordinal_cut_folds(train, y, n_class, folds, key, "__fold")
    tr = _prepare(train.select("*", *[(F.col(y) <= k + 1).cast("double").alias(lab)
                                      for k, lab in enumerate(labs)]), features)
    te = assemble(test, features)
    fitted = fit_parallel([j for k, lab in enumerate(labs) for j in _fold_jobs(tr, kind, lab, folds, f"__fold{k}", True)], params)
    cols = [f"bump_{k}" for k in range(n_class - 1)]
    for k, c in enumerate(cols):
        own = fitted[k * (folds + 1):(k + 1) * (folds + 1)]
        tr = fold_prediction(own[:folds], tr, f"__fold{k}", c)
        te = predict(own[folds], te, c)
    return tr.select(key, *cols).unionByName(te.select(key, *cols))


class Scaled(Model):
    """A model of standardised features: mean and population deviation of its own fit rows."""

    def __init__(self, mean: list[float], std: list[float], model, features: str = "features"):
        super().__init__()
        self.mean, self.std, self.model, self.features = mean, std, model, features

    def scale(self, df: DataFrame) -> DataFrame:
        # element by element, not by a lambda, which would not be compiled
        x = [(F.col("__x")[i] - float(m)) / float(s) if s > 0 or math.isnan(s) else F.lit(0.0)
             for i, (m, s) in enumerate(zip(self.mean, self.std))]
        return df.withColumn("__x", vector_to_array(self.features)).withColumn("__scaled", array_to_vector(F.array(*x))).drop("__x")

    def _transform(self, dataset):
        return self.model.transform(self.scale(dataset)).drop("__scaled")


def fit_scaled(kind: str, label: str, rows: DataFrame, **params) -> Scaled:
    """An estimator fitted on its rows' standardised features."""
    got = rows.agg(Summarizer.mean(F.col("features")).alias("m"), Summarizer.variance(F.col("features")).alias("v"),
                   F.count(F.lit(1)).alias("n")).first()
    n = max(got["n"], 1)
    std = [math.sqrt(max(v, 0.0) * (n - 1) / n) for v in got["v"].toArray()]
    empty = Scaled(got["m"].toArray().tolist(), std, None)
    scaled = empty.scale(rows).select(label, "__scaled").persist()  # several classes are fitted on it
    model = estimator(kind, label, "__scaled", **params).fit(scaled)
    scaled.unpersist()
    return Scaled(empty.mean, std, model)


def oof_multiclass(train: DataFrame, test: DataFrame, features: list[str], y: str, n_class: int,
                   models: dict[str, tuple[str, dict]], folds: int, fold_col: str = "fold", key: str = "id",
                   scale: bool = False) -> DataFrame:
    """K2: out-of-fold class probabilities of several classifiers, columns
    ``<name>_1..<name>_n`` in the order of ``models`` (name: (kind,
    parameters)). Labels 1..n are shifted to 0..n-1 for Spark ML. With
    ``scale`` every fit standardises the features by its own rows: a fold's
    models by the other folds, the test side's by all train rows."""
    lab = "__lab"
    tr = _prepare(train.withColumn(lab, (F.col(y) - 1).cast("double")), features)
    te = assemble(test, features)
    n_rows = {r[fold_col]: r["count"] for r in tr.groupBy(fold_col).count().collect()}
    total = sum(n_rows.values())
    jobs = []
    for kind, params in models.values():
        own = {**params, **({} if kind == "logistic" else {"classes": n_class})}
        for k in [*range(folds), None]:
            rows = tr if k is None else tr.where(F.col(fold_col) != k)
            size = {"n_rows": total - n_rows.get(k, 0)} if kind == "logistic" else {}
            jobs.append((kind, lab, rows, {**own, **size}))
    if scale:
        with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
            fitted = list(pool.map(lambda j: fit_scaled(j[0], j[1], j[2], **j[3]), jobs))
    else:
        fitted = fit_parallel(jobs, {})
    drop = ["rawPrediction", "probability", "prediction"]
    cols = []
    for i, name in enumerate(models):
        own = fitted[i * (folds + 1):(i + 1) * (folds + 1)]
        parts = [f"__{name}_fold{k}" for k in range(folds)]
        for m, n in zip(own, parts):
            tr = m.transform(tr).withColumn(n, vector_to_array(F.col("probability"))).drop(*drop)
        tr = tr.withColumn("__p", F.element_at(F.array(*parts), F.col(fold_col).cast("int") + 1))
        te = own[folds].transform(te).withColumn("__p", vector_to_array(F.col("probability"))).drop(*drop)
        new = {f"{name}_{c + 1}": F.col("__p")[c] for c in range(n_class)}
        tr, te = tr.withColumns(new).drop(*parts, "__p"), te.withColumns(new).drop("__p")
        cols += list(new)
    return tr.select(key, *cols).unionByName(te.select(key, *cols))


#: The share of the fit rows, in key order, that a boosted model is fitted on; the rest ends its rounds.
BOOST_FIT_SHARE = 0.8


def _with_validation(kind: str, params: dict, rows: DataFrame, key: str) -> tuple[dict, DataFrame]:
    """A boosted model with patience gets the last rows in key order as its validation side."""
    if kind not in ("boost", "softmax_boost", "boost_reg") or "patience" not in params:
        return params, rows
    split = positional_holdout(rows, BOOST_FIT_SHARE, key, "__fit")
    return {**params, "valid_col": "__valid"}, split.withColumn("__valid", ~F.col("__fit")).drop("__fit")


def holdout_stack(df: DataFrame, test: DataFrame, features: list[str], label: str, models: dict,
                  fit_col: str = "is_fit", key: str = "id") -> tuple[DataFrame, DataFrame]:
    """K5: level-1 models fit on the fit side; their predictions on the
    other train rows and on test become new columns of those rows."""
    fit_part = _prepare(df.where(F.col(fit_col)), features)
    rest, te = assemble(df.where(~F.col(fit_col)), features), assemble(test, features)
    jobs = []
    for kind, params in models.values():
        own, rows = _with_validation(kind, params, fit_part, key)
        jobs.append((kind, label, rows, own))
    for name, m in zip(models, fit_parallel(jobs, {})):
        rest, te = predict(m, rest, name), predict(m, te, name)
    fit_part.unpersist()
    return rest.drop("features"), te.drop("features")


def meta_learner(train: DataFrame, test: DataFrame, cols: list[str], label: str, kind: str = "logistic",
                 seeds: list[int] | None = None, key: str = "id", name: str = "pred", **params) -> DataFrame:
    """K6/K7/K8: a second-level model on prediction columns; with several
    seeds the test predictions are averaged (A24)."""
    tr = _prepare(train, cols)
    params, rows = _with_validation(kind, _with_rows(kind, params, tr), tr, key)
    fitted = fit_parallel([(kind, label, rows, {"seed": s}) for s in seeds or [2017]], params)
    tr.unpersist()
    return mean_prediction(fitted, assemble(test, cols), name).select(key, name)


def soft_vote(train: DataFrame, test: DataFrame, features: list[str], label: str, models: dict,
              key: str = "id", name: str = "pred") -> DataFrame:
    """K9: equal-weight mean of the classifiers' P(class 1)."""
    tr = _prepare(train, features)
    fitted = fit_parallel([(kind, label, tr, params) for kind, params in models.values()], {})
    tr.unpersist()
    return mean_prediction(fitted, assemble(test, features), name).select(key, name)


def logit_feature(train: DataFrame, apply: DataFrame, features: list[str], label: str, C: float = 10.0,
                  key: str = "id", name: str = "logit_feat") -> DataFrame:
    """Logistic regression (C as in the source, no standardisation)
    on one-hot columns; the feature is ``ln P(y=1)``."""
    n = train.count()
    m = estimator("logistic", label, C=C, n_rows=n, max_iter=300, tol=1e-10).fit(_prepare(train, features))
    p = predict(m, assemble(apply, features), "__p")
    return p.select(key, F.log(F.col("__p")).alias(name))


def logit_feature_from_categoricals(train: DataFrame, apply: DataFrame, cats: list[str], label: str,
                                    k: int = 200, C: float = 10.0, key: str = "id",
                                    name: str = "logit_feat") -> DataFrame:
    """E18 end to end: the ``k`` dummies most correlated with the label
    (closed form, train rows), built only for those, then the logit feature."""
    from stackyard.operators.assoc import top_dummies_by_target_corr
    top = top_dummies_by_target_corr(train, cats, label, k)

    def dummies_of(df):
        cols = [F.coalesce((F.coalesce(F.col(c).cast("string"), F.lit("nan")) == F.lit(v)).cast("double"),
                           F.lit(0.0)).alias(f"{c}__{v}") for c, v in top]
        return df.select(key, label, *cols) if label in df.columns else df.select(key, *cols)

    feats = [f"{c}__{v}" for c, v in top]
    return logit_feature(dummies_of(train), dummies_of(apply), feats, label, C, key, name)


def logit_feature_in_folds(train: DataFrame, features: list[str], label: str, folds: int,
                           fold_col: str = "fold", key: str = "id", C: float = 10.0,
                           name: str = "logit_feat") -> DataFrame:
    """The logit feature refit inside each fold (leak-free): each
    fold's rows get the feature from a model fitted on the other folds. One
    grouped count gives all fits their rows; the fits run side by side, and the
    models are applied to the same rows one after another."""
    tr = _prepare(train, features)
    size = {r[fold_col]: r["count"] for r in tr.groupBy(fold_col).count().collect()}
    total = sum(size.values())
    jobs = [("logistic", label, tr.where(F.col(fold_col) != k), {"n_rows": max(total - size.get(k, 0), 1)}) for k in range(folds)]
    fitted = fit_parallel(jobs, {"C": C, "max_iter": 300, "tol": 1e-10})
    return fold_prediction(fitted, tr, fold_col, "__p").select(key, F.log("__p").alias(name))


def _loss_expr(y: str, p: str):
    pc = F.least(F.greatest(F.col(p), F.lit(1e-15)), F.lit(1 - 1e-15))
    return -F.avg(F.col(y) * F.log(pc) + (1 - F.col(y)) * F.log(1 - pc))


@dataclass
class _Group:
    """A linear feature group: its columns and the log loss of their
    no-intercept least-squares prediction (None until a column has joined)."""
    members: list[str]
    loss: float | None = None


class LinearGroups:
    """Greedy linear feature groups.

    The columns are taken in a seeded random order. The first ``n`` open a
    group each. Every later column is scored against all groups with room
    (``max_elts`` members at most): the candidate table has a row (group, loss of
    the prediction with the column). A scan scores the columns ahead as well;
    their losses hold until their group changes. A group that no
    column has joined takes the column with the least loss; otherwise the
    column joins the group whose loss it lowers most, or none. All
    least-squares solves use one Gram-matrix pass. ``transform`` adds one
    column per group.
    """

    def __init__(self, n: int = 1, max_elts: int | None = None, seed: int | None = None):
        self.n, self.max_elts, self.seed = n, max_elts, seed
        self.groups: list[list[str]] = []
        self.coefs: list[dict[str, float]] = []

    @staticmethod
    def _weights(gram: dict, members: list[str], label: str) -> dict[str, float]:
        a = np.array([[gram[x, y] for y in members] for x in members])
        w, *_ = np.linalg.lstsq(a, np.array([gram[x, label] for x in members]), rcond=None)
        return dict(zip(members, map(float, w)))

    @staticmethod
    def _prediction(weights: dict[str, float]):
        return reduce(operator.add, [F.lit(w) * F.col(c) for c, w in weights.items()])

    def _losses(self, d: DataFrame, gram: dict, wanted: list[tuple], label: str) -> list[float]:
        """Log losses of the wanted (members, column) pairs, in one scan."""
        predicted = [self._prediction(self._weights(gram, [*members, column], label)) for members, column in wanted]
        scored = d.select(label, *[p.alias(f"p{i}") for i, p in enumerate(predicted)])
        return list(scored.agg(*[_loss_expr(label, f"p{i}") for i in range(len(wanted))]).first())

    def fit(self, df: DataFrame, cols: list[str], label: str) -> "LinearGroups":
        d = cut_lineage(df.select(label, *cols).fillna(0.0, subset=cols)).persist()
        gram = sums_of_products(d, [*cols, label])
        order = sorted(cols)
        random.Random(self.seed).shuffle(order)
        groups = [_Group([c]) for c in order[:self.n]]
        rest = order[self.n:]
        known: dict[tuple, float] = {}  # (members, column): loss; stays until the group changes
        for at, column in enumerate(rest):
            room = [g for g in groups if self.max_elts is None or len(g.members) < self.max_elts]
            if not room:
                break
            if any((tuple(g.members), column) not in known for g in room):
                # one scan for this column and for as many later ones as fit into it
                wanted = [(tuple(g.members), c) for c in rest[at:] for g in room if (tuple(g.members), c) not in known][:LOSS_BATCH]
                known |= dict(zip(wanted, self._losses(d, gram, wanted, label)))
            table = [(g, known[tuple(g.members), column]) for g in room]
            fresh = [(loss, g) for g, loss in table if g.loss is None]
            if fresh:
                loss, group = min(fresh, key=lambda t: t[0])
            else:
                better = [(loss - g.loss, loss, g) for g, loss in table if loss < g.loss]
                if not better:
                    continue
                _, loss, group = min(better, key=lambda t: t[0])
            group.members.append(column)
            group.loss = loss
        self.groups = [g.members for g in groups]
        self.coefs = [self._weights(gram, g.members, label) for g in groups]
        self.cols = cols
        d.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        d = df.fillna(0.0, subset=self.cols)
        return d.select("*", *[self._prediction(w).alias("_".join(sorted(w))) for w in self.coefs])


def chi2_select(df: DataFrame, cols: list[str], label: str, k: int) -> list[str]:
    """L2: chi² selection on binarised (0/1) features."""
    a = VectorAssembler(inputCols=cols, outputCol="__f", handleInvalid="keep").transform(df.fillna(0, subset=cols))
    sel = UnivariateFeatureSelector(featuresCol="__f", labelCol=label, outputCol="__sel",
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(k)
    model = sel.fit(a)
    return [cols[i] for i in sorted(model.selectedFeatures)]


def importance_select(df: DataFrame, cols: list[str], label: str, threshold: float = 0.0,
                      **params) -> list[tuple[str, float]]:
    """L3: fit a forest and keep features with importance above
    ``threshold`` (name, importance), largest first."""
    from stackyard.operators.models import feature_importances
    m = estimator("forest", label, **params).fit(assemble(df, cols))
    return [t for t in feature_importances(m, cols) if t[1] > threshold]
