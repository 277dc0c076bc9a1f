"""Boosting, random thresholds, sweeps and estimators: properties and small exact cases."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stackyard.operators import boosting as BO
from stackyard.operators import extra_trees as XT
from stackyard.operators import models as MO
from stackyard.operators import stack as ST
from stackyard.operators.estimators import (AnovaSelector, LinearGroupsFeature, LinearGroupsModel, LogitFeature, LogitFeatureModel)
from stackyard.operators.metrics import log_loss
from stackyard.plans.q_models import ord_feats, ordinal_features

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def noisy(spark):
    """A learnable label with noise; a quarter of the rows to validate on."""
    rng = np.random.default_rng(8)
    x = rng.uniform(-1, 1, (1200, 3))
    p = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1] - x[:, 0]))
    y = (rng.random(1200) < p).astype(float)
    rows = [(i, *map(float, r), float(t), i % 4 == 0) for i, (r, t) in enumerate(zip(x, y))]
    return MO.assemble(spark.createDataFrame(rows, "id long, a double, b double, c double, label double, valid boolean"), ["a", "b", "c"]).persist()


def multiclass_loss(df, n):
    p = vector_to_array("probability")
    own = F.element_at(p, F.col("label").cast("int") + 1)
    return df.agg(-F.avg(F.log(F.greatest(own, F.lit(1e-15))))).first()[0]


def test_softmax_probabilities_and_loss_below_one_against_rest(spark):
    d = ordinal_features(spark, SF).where("is_train").withColumn("label", (F.col("response") - 1).cast("double"))
    # a label that the features tell something about
    d = d.withColumn("label", F.when(F.col("size_mod") < 3, F.lit(0.0)).when(F.col("p_retailprice") > 1400, F.lit(1.0)).otherwise(F.col("label") % 3))
    rows = MO.assemble(d, ord_feats(d))
    fit, held = rows.where("id % 4 <> 0"), rows.where("id % 4 = 0")
    m = MO.estimator("softmax_boost", "label", classes=3, rounds=4, max_depth=3, rate=0.5).fit(fit)
    out = m.transform(held)
    sums = out.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.where("abs(s - 1) > 1e-9").count() == 0
    scores = []
    for k in range(3):
        one = MO.estimator("boost", "label", rounds=4, max_depth=3, rate=0.5).fit(fit.withColumn("label", (F.col("label") == k).cast("double")))
        scores.append(one)
    rest = held
    for k, one in enumerate(scores):
        rest = MO.predict(one, rest, f"p{k}")
    total = sum(F.col(f"p{k}") for k in range(3))
    own = F.element_at(F.array(*[F.col(f"p{k}") / total for k in range(3)]), F.col("label").cast("int") + 1)
    against = rest.agg(-F.avg(F.log(F.greatest(own, F.lit(1e-15))))).first()[0]
    assert multiclass_loss(out, 3) <= against + 1e-6


def test_losses_fall_on_the_fit_side_and_staged_losses_agree(spark, noisy):
    m = BO.BoostedTrees("logistic", rounds=6, max_depth=3, rate=0.3, valid_col="valid").fit(noisy)
    train = [t for _, t, _ in m.curve]
    assert all(b < a for a, b in zip(train, train[1:]))
    staged = {r["round"]: r["loss"] for r in BO.staged_losses(m, noisy.where("valid")).collect()}
    assert staged == pytest.approx({r: v for r, _, v in m.curve})
    direct = log_loss(MO.predict(m, noisy.where("valid")), "label", "pred").first()[0]
    assert direct == pytest.approx(m.curve[-1][2])


def test_patience_stops_an_overfit_and_scores_by_the_best_prefix(spark, noisy):
    m = BO.BoostedTrees("logistic", rounds=40, max_depth=6, rate=0.8, valid_col="valid", patience=3).fit(noisy)
    valid = [v for _, _, v in m.curve]
    assert len(m.curve) < 41  # ended before its rounds
    assert m.best_round == int(np.argmin(valid)) and m.best_score == min(valid)
    assert len(m.curve) - 1 - m.best_round == 3
    loss = log_loss(MO.predict(m, noisy.where("valid")), "label", "pred").first()[0]
    assert loss == pytest.approx(min(valid))
    whole = m.prefix(len(m.rounds))
    assert log_loss(MO.predict(whole, noisy.where("valid")), "label", "pred").first()[0] == pytest.approx(valid[-1])
    rows = BO.curve_table(spark, m).collect()
    assert [r["round"] for r in rows if r["is_best"]] == [m.best_round]


def test_boosting_by_hand(spark):
    """Two groups, squared loss: after r rounds of rate 0.5 half the distance is left each time."""
    rows = [(float(g), v) for g, v in ((0, 1.0), (0, 3.0), (1, 10.0), (1, 10.0))]
    d = MO.assemble(spark.createDataFrame(rows, "g double, label double"), ["g"])
    m = MO.estimator("boost_reg", rounds=3, max_depth=2, rate=0.5).fit(d)
    got = {r["g"]: r["prediction"] for r in m.transform(d).collect()}
    assert got == pytest.approx({0.0: 6 - 4 * (1 - 0.5 ** 3), 1.0: 6 + 4 * (1 - 0.5 ** 3)})


def test_weights_count_as_repeated_rows(spark):
    once = spark.createDataFrame([(0.0, 1.0, 3.0), (0.0, 0.0, 1.0), (1.0, 1.0, 1.0), (1.0, 0.0, 4.0)], "x double, label double, w double")
    m = BO.BoostedTrees("logistic", rounds=6, max_depth=2, rate=1.0, weight="w").fit(MO.assemble(once, ["x"]))
    got = {r["x"]: r["pred"] for r in MO.predict(m, MO.assemble(once, ["x"])).collect()}
    assert got == pytest.approx({0.0: 0.75, 1.0: 0.2}, abs=1e-5)


def test_refused_boosting_settings():
    with pytest.raises(ValueError):
        BO.BoostedTrees("hinge")
    with pytest.raises(ValueError):
        BO.BoostedTrees("logistic", patience=2)


def test_seeds_draw_different_thresholds(spark, noisy):
    a, b, again = (MO.estimator("extra_trees", trees=3, max_depth=4, seed=s).fit(noisy) for s in (1, 2, 1))
    assert a.thresholds() != b.thresholds() and a.thresholds() == again.thresholds()
    assert a.thresholds()[0] != a.thresholds()[1]
    low, high = noisy.agg(F.min("a"), F.max("a")).first()
    assert all(low <= c <= high for t in a.thresholds() for c in t[0])
    assert XT.drawn_cuts([0.0, 5.0], [1.0, 5.0], 4, 9)[1] == []  # a constant feature has none


def test_extra_trees_beat_the_prior_and_probabilities_sum_to_one(spark, noisy):
    m = MO.estimator("extra_trees", trees=8, max_depth=6, max_features="all").fit(noisy.where("NOT valid"))
    loss = log_loss(MO.predict(m, noisy.where("valid")), "label", "pred").first()[0]
    share = noisy.where("NOT valid").agg(F.avg("label")).first()[0]
    const = log_loss(noisy.where("valid").withColumn("p", F.lit(share)), "label", "p").first()[0]
    assert loss < const
    three = noisy.withColumn("label", (F.col("id") % 3).cast("double"))
    p = MO.estimator("extra_trees", trees=2, max_depth=3, classes=3).fit(three).transform(three)
    s = p.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert s.where("abs(s - 1) > 1e-9").count() == 0


def test_sweep_gives_the_same_rows_in_any_order(spark, noisy):
    d = noisy.withColumn("fold", (F.col("id") % 2).cast("int"))
    points = MO.grid_points(["tree", "boost"], {"max_depth": [2, 3], "min_leaf": [1, 40]}, {"boost": {"rounds": 2, "rate": 0.5, "patience": 1}})
    assert len(points) == 8
    one, two = MO.grid_sweep(d, points, 2), MO.grid_sweep(d, points[::-1], 2)
    assert len(one.columns) == 19
    strip = lambda df: [tuple(v for k, v in r.asDict().items() if k != "seconds") for r in df.collect()]
    assert strip(one) == strip(two)[::-1]
    log = {(r["model"], r["depth"], r["weight"]): r for r in one.collect()}
    assert log["BTC", 2, 1]["best_round_max"] is not None and log["DTC", 2, 1]["rate"] is None
    assert log["DTC", 3, 1]["cv_loss"] != log["DTC", 3, 40]["cv_loss"]  # the leaf size is a part of the point


def test_cv_uses_the_best_round_of_each_fold(spark, noisy):
    d = noisy.withColumn("fold", (F.col("id") % 2).cast("int"))
    cv = {r["fold"]: r for r in MO.cv_score(d, "boost", 2, rounds=12, max_depth=5, rate=0.8, patience=2).collect()}
    by_hand = BO.BoostedTrees("logistic", rounds=12, max_depth=5, rate=0.8, valid_col="out", patience=2).fit(d.withColumn("out", F.col("fold") == 0))
    assert cv[0]["best_round"] == by_hand.best_round and cv[0]["cv_loss"] == pytest.approx(by_hand.best_score)


# ------------------------------------------------------------ estimators

def test_estimators_and_models_are_written_and_read(spark, noisy, tmp_path):
    d = noisy.drop("features")
    est = LogitFeature(inputCols=["a", "b"], C=5.0)
    est.write().overwrite().save(str(tmp_path / "est"))
    again = LogitFeature.load(str(tmp_path / "est"))
    assert again.getInputCols() == ["a", "b"] and again.getOrDefault(again.C) == 5.0
    m = est.fit(d)
    m.write().overwrite().save(str(tmp_path / "m"))
    back = LogitFeatureModel.load(str(tmp_path / "m"))
    assert back.transform(d).exceptAll(m.transform(d)).count() == 0
    g = LinearGroupsFeature(inputCols=["a", "b", "c"], groups=2, maxElements=2, seed=4).fit(d)
    g.write().overwrite().save(str(tmp_path / "g"))
    assert LinearGroupsModel.load(str(tmp_path / "g")).transform(d).exceptAll(g.transform(d)).count() == 0


def test_linear_groups_estimator_equals_the_class(spark, noisy):
    d = noisy.drop("features")
    plain = ST.LinearGroups(n=1, max_elts=2, seed=4).fit(d, ["a", "b", "c"], "label")
    est = LinearGroupsFeature(inputCols=["a", "b", "c"], groups=1, maxElements=2, seed=4).fit(d)
    assert est.group_weights() == plain.coefs
    assert est.transform(d).exceptAll(plain.transform(d)).count() == 0


def test_pipeline_is_written_read_and_safe_in_folds(spark, noisy, tmp_path):
    d = noisy.drop("features").withColumn("fold", (F.col("id") % 3).cast("int"))
    pipe = Pipeline(stages=[LogitFeature(inputCols=["a", "b"]), AnovaSelector(inputCols=["a", "c", "logit_feat"], k="2")])
    m = pipe.fit(d)
    m.write().overwrite().save(str(tmp_path / "pipe"))
    assert PipelineModel.load(str(tmp_path / "pipe")).transform(d).exceptAll(m.transform(d)).count() == 0
    # labels of a fold do not move what the fold's rows get
    seen = d.where("fold <> 0")
    turned = d.withColumn("label", F.when(F.col("fold") == 0, 1 - F.col("label")).otherwise(F.col("label")))
    one, two = pipe.fit(seen), pipe.fit(turned.where("fold <> 0"))
    assert one.transform(d).select("id", "logit_feat").exceptAll(two.transform(d).select("id", "logit_feat")).count() == 0
    cv = MO.cv_score(d, "tree", 3, stages=[LogitFeature(inputCols=["a", "b"])], features=["a", "b", "c", "logit_feat"], max_depth=3).collect()
    flipped = MO.cv_score(turned, "tree", 3, stages=[LogitFeature(inputCols=["a", "b"])], features=["a", "b", "c", "logit_feat"], max_depth=3).collect()
    assert cv[0]["train_loss"] == pytest.approx(flipped[0]["train_loss"]) and cv[0]["cv_loss"] != flipped[0]["cv_loss"]


def test_logit_feature_is_finite_far_out(spark):
    m = LogitFeatureModel(inputCols=["x"], coefficients=[1.0], intercept=0.0)
    got = [r["logit_feat"] for r in m.transform(spark.createDataFrame([(-2000.0,), (0.0,), (2000.0,), (None,)], "x double")).collect()]
    assert got == pytest.approx([-2000.0, math.log(0.5), 0.0, math.log(0.5)])


def test_scaled_models_are_fitted_on_their_own_rows(spark, noisy):
    m = ST.fit_scaled("logistic", "label", noisy.where("valid"), n_rows=300)
    z = m.scale(noisy.where("valid")).select(vector_to_array("__scaled").alias("z"))
    mean, var = z.agg(F.avg(F.col("z")[0]), F.var_pop(F.col("z")[0])).first()
    assert mean == pytest.approx(0, abs=1e-9) and var == pytest.approx(1)
    assert m.transform(noisy).select("probability").count() == 1200


def test_bins_count_the_cuts_below_a_value_without_lambdas(spark):
    cuts = [[-1.0, 0.0, 0.0, 2.5], [], [5e-324, 1.0]]
    values = [-2.0, -1.0, -0.0, 0.0, 1e-300, 1.0, 2.5, 3.0, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([([v, v, v],) for v in values], "v array<double>")
    out = XT.binned(df, "v", cuts, "b")
    below = lambda c, v: v != v or c < v
    for r in out.collect():
        assert r["b"].toArray().tolist() == [float(sum(below(c, v) for c in own)) for own, v in zip(cuts, r["v"])]
    assert out.columns == ["v", "b"]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_softmax_works_each_total_out_once(spark):
    df = spark.createDataFrame([([1.0, -2.0, 0.5],), ([0.0, 0.0, 700.0],)], "s array<double>")
    out = df.select("s", BO.Loss("softmax", 3).probabilities(F.col("s")).alias("p"))
    for r in out.collect():
        e = [math.exp(x - max(r["s"])) for x in r["s"]]
        assert r["p"] == pytest.approx([x / sum(e) for x in e], abs=1e-15)
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_scaled_models_scale_without_lambdas(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 7.0]),), (Vectors.dense([4.0, 7.0]),)], ["features"])
    out = ST.Scaled([2.0, 7.0], [0.5, 0.0], None).scale(df)
    assert sorted(r["__scaled"].toArray().tolist() for r in out.collect()) == [[-2.0, 0.0], [4.0, 0.0]]
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString() and out.columns == ["features", "__scaled"]


def test_sweeps_keep_what_their_fits_read(spark, noisy):
    seen = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(MO, "_fold_result", lambda df, *a: seen.append(df.columns) or MO.FoldResult(0, 1.0, 1.0, 0, 0.0))
        MO.cv_score(noisy.withColumn("fold", F.col("id") % 2).withColumn("other", F.lit("x")), "tree", 2)
    assert seen == [["label", "fold", "features"]] * 2


def test_log_loss_reads_each_prediction_once(spark):
    df = spark.createDataFrame([(1.0, 0.5, "a"), (None, 0.5, "a"), (0.0, None, "a"), (None, 0.25, "b"), (0.0, 0.75, "c")],
                               "y double, p double, g string")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def model(v):
        calls.add(1)
        return v

    scored = df.withColumn("q", model("p"))
    got = {r["g"]: r["logloss"] for r in log_loss(scored, "y", "q", by=["g"]).collect()}
    assert got == pytest.approx({"a": math.log(2), "c": 2 * math.log(2)}) and calls.value == 5
    assert log_loss(df.where("g = 'b'"), "y", "p").first()[0] is None
    plan = log_loss(scored, "y", "q", by=["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("model(") == 1
