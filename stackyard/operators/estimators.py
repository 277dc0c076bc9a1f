"""Feature makers as Spark ML estimators.

Their parameters and everything they learn are ``Param`` values, so estimators
and models are written and read by Spark ML's own metadata, and fit inside a
``Pipeline`` (which is how a fold learns a feature from its own rows only).
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F


class _LogitParams(HasInputCols, HasLabelCol, HasOutputCol):
    C = Param(Params._dummy(), "C", "inverse strength of the penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations at most", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(C=10.0, maxIter=300, labelCol="label", outputCol="logit_feat")


class LogitFeature(Estimator, _LogitParams, DefaultParamsReadable, DefaultParamsWritable):
    """A logistic regression of the label on ``inputCols`` (nulls as 0); the
    feature is the log of its probability."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", outputCol="logit_feat", C=10.0, maxIter=300):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        from stackyard.operators.models import assemble, estimator

        cols, label = self.getInputCols(), self.getLabelCol()
        rows = assemble(dataset.where(F.col(label).isNotNull()).select(label, *cols), cols, "__x", fill=0.0).persist()
        m = estimator("logistic", label, "__x", C=self.getOrDefault(self.C), n_rows=max(rows.count(), 1),
                      max_iter=self.getOrDefault(self.maxIter), tol=1e-10).fit(rows)
        rows.unpersist()
        return LogitFeatureModel(inputCols=cols, outputCol=self.getOutputCol(),
                                 coefficients=[float(x) for x in m.coefficients], intercept=float(m.intercept))


class LogitFeatureModel(Model, _LogitParams, DefaultParamsReadable, DefaultParamsWritable):
    coefficients = Param(Params._dummy(), "coefficients", "a weight for each input column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "the constant", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="logit_feat", coefficients=None, intercept=0.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        z = F.lit(self.getOrDefault(self.intercept))
        for c, w in zip(self.getInputCols(), self.getOrDefault(self.coefficients)):
            z = z + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        # ln(1 / (1 + exp(-z))), from the side that does not overflow
        log_p = -F.greatest(-z, F.lit(0.0)) - F.log1p(F.exp(-F.abs(z)))
        return dataset.withColumn(self.getOutputCol(), log_p)


class _GroupParams(HasInputCols, HasLabelCol, HasSeed):
    groups = Param(Params._dummy(), "groups", "number of groups", TypeConverters.toInt)
    maxElements = Param(Params._dummy(), "maxElements", "members of a group at most (0: any number)", TypeConverters.toInt)


class LinearGroupsFeature(Estimator, _GroupParams, DefaultParamsReadable, DefaultParamsWritable):
    """Greedy linear feature groups (:class:`stackyard.operators.stack.LinearGroups`)."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", groups=1, maxElements=0, seed=0):
        super().__init__()
        self._setDefault(labelCol="label", groups=1, maxElements=0, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        from stackyard.operators.stack import LinearGroups

        fitted = LinearGroups(self.getOrDefault(self.groups), self.getOrDefault(self.maxElements) or None, self.getSeed())
        fitted.fit(dataset, self.getInputCols(), self.getLabelCol())
        return LinearGroupsModel(weights=json.dumps(fitted.coefs))


class LinearGroupsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds a column for each group, named by its members: their weighted sum, nulls as 0."""

    weights = Param(Params._dummy(), "weights", "for each group its columns' weights, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, weights="[]"):
        super().__init__()
        self._set(**self._input_kwargs)

    def group_weights(self) -> list[dict[str, float]]:
        return json.loads(self.getOrDefault(self.weights))

    def _transform(self, dataset):
        out = []
        for group in self.group_weights():
            total = F.lit(0.0)
            for c, w in group.items():
                total = total + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            out.append(total.alias("_".join(sorted(group))))
        return dataset.select("*", *out)


class _SelectorParams(HasInputCols, HasLabelCol, HasOutputCol):
    k = Param(Params._dummy(), "k", "features to keep: a number or 'all' (empty: by percentile)", TypeConverters.toString)
    percentile = Param(Params._dummy(), "percentile", "percent of the features to keep", TypeConverters.toFloat)


class AnovaSelector(Estimator, _SelectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """L1: the columns with the largest ANOVA F against the label, as a feature vector."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", outputCol="features", k="", percentile=100.0):
        super().__init__()
        self._setDefault(labelCol="label", outputCol="features", k="", percentile=100.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        from stackyard.operators.assoc import selected_columns

        k = self.getOrDefault(self.k)
        how = {"k": k if k == "all" else int(k)} if k else {"percentile": self.getOrDefault(self.percentile)}
        kept = selected_columns(dataset, self.getInputCols(), self.getLabelCol(), **how)
        return AnovaSelectorModel(inputCols=kept, outputCol=self.getOutputCol())


class AnovaSelectorModel(Model, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Assembles the kept columns (``inputCols``), nulls as the source fills them."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        from stackyard.operators.models import assemble

        return assemble(dataset, self.getInputCols(), self.getOutputCol())
